"""Quality rules: counts of a text's own words and lines, and lines repeated across a host's documents.

Lines are normalised and hashed, and the distinct documents of a host that have a line are
counted.  Lines that too many of them share are removed, and a document that loses most of
its words with them is rejected.

Near copies share nearly all lines and are still one document to a line.  What tells them from the users of a template
is a line of one's own: one that is no variant of a line which the others have.  Variants agree in three words at an end
of the line, or the three next to them.  So all documents without such a line count as one.  Everything is SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.store import carrying, join_small, staged, unpacked, with_length

#: A line is boilerplate if at least MIN_DOCS documents and LIMIT_PERCENT of its host's documents have it,
#: or MANY_DOCS documents whatever their share.
MIN_DOCS = 5
LIMIT_PERCENT = 2
MANY_DOCS = 50
#: A line of so many words can be a document's own: the three words at its ends do not overlap.
OWN_WORDS = 6
#: A document is depleted if fewer than this share of its words is left.
LEFT_PERCENT = 50

SPACES = r"[\\x20\\x09-\\x0D]+"
NOT_SPACE = r"[^\\x20\\x09-\\x0D]"


def _line_hash(words: str) -> str:
    """SQL of the hash of a line's words in lower case with single spaces."""
    return f"xxhash64(lower(array_join({words}, ' ')))"


def _words(text: str) -> str:
    return f"array_remove(split({text}, '{SPACES}'), '')"


def host() -> Column:
    """``source`` as a host; null is a host."""
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))


def text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, host, text_key, the counts of the text and ``lines``: hash, words and anchors of each line with a word.

    Words in windows that are found again: the hashes of all 3-word windows are sorted together with their
    positions, packed in one long (the position in the low bits), so equal windows are neighbours.
    """
    text = docs.select("doc_id", host().alias("host"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    split = text.withColumns(
        {
            "words": F.expr(_words("text")),
            "lines": F.expr(rf"filter(split(text, '\\n'), x -> x rlike '{NOT_SPACE}')"),
            "text_key": F.xxhash64("text"),
        }
    )
    sized = split.withColumns(
        {
            "n": F.size("words"),
            "bits": F.expr("length(bin(size(words)))"),
            "line_words": F.expr(f"transform(lines, x -> {_words('x')})"),
            "windows": F.expr(
                "transform(slice(words, 1, greatest(0, size(words) - 2)), (w, i) -> xxhash64(w, get(words, i + 1), get(words, i + 2)))"
            ),
        }
    )
    packed = sized.withColumn(
        "sorted",
        F.expr("sort_array(transform(windows, (h, i) -> coalesce(shiftleft(shiftright(h, bits), bits) | cast(i as bigint), 0L)))"),
    )
    low = "(shiftleft(1L, bits) - 1)"
    same = f"(shiftright(x, bits) = shiftright(y, bits) and get(windows, cast(x & {low} as int)) = get(windows, cast(y & {low} as int)))"
    again = packed.withColumn(
        "again",
        F.expr(
            "filter(sorted, (x, k) -> (k > 0 and "
            + same.replace("y", "get(sorted, k - 1)")
            + ") or (k + 1 < size(sorted) and "
            + same.replace("y", "get(sorted, k + 1)")
            + "))"
        ),
    )
    return again.select(
        "doc_id",
        "host",
        "text_key",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) as bigint)").alias("n_dup_lines"),
        F.expr(
            f"aggregate(sort_array(transform(again, x -> x & {low})), named_struct('n', 0L, 'last', -3L),"
            " (a, p) -> named_struct('n', a.n + least(3L, p - a.last), 'last', p), a -> a.n)"
        ).alias("n_repeat_words"),
        F.expr(
            f"transform(line_words, w -> named_struct('line', {_line_hash('w')}, 'words', size(w), 'anchors',"
            f" if(size(w) >= {OWN_WORDS}, array_distinct(transform(array(1, 4, size(w) - 5, size(w) - 2), k -> {_line_hash('slice(w, k, 3)')})), null)))"
        ).alias("lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def distinct_texts(base: DataFrame) -> DataFrame:
    """host, text_key, lines of every distinct text of a host: copies are one document."""
    return base.groupBy("host", "text_key").agg(F.first("lines").alias("lines"))


def frequent_lines(texts: DataFrame) -> DataFrame:
    """host, line: the lines that more of a host's distinct documents have than the limits allow, near copies counted as one.

    Hot hosts and lines combine before they are shuffled.  First all texts count; only those with a line that can be
    frequent are looked at again.  A text is independent of the others with a line if one of its own lines shares its
    anchors with less than half as many texts as have the line.
    """
    line = F.explode(F.expr("array_distinct(transform(lines, x -> x.line))")).alias("line")
    having = texts.select("host", "text_key", line)
    counts = having.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_DOCS)
    limits = counts.join(texts.groupBy("host").agg(F.count("*").alias("n_docs")), "host").where(_frequent("n"))
    candidates = staged(limits, "candidates")
    uses = staged(join_small(having, candidates, ["host", "line"], "inner"), "uses")

    sharing = staged(uses.select("host", "text_key").distinct(), "sharing")
    long_lines = join_small(texts, sharing, ["host", "text_key"], "left_semi").select(
        "host", "text_key", F.expr(f"filter(lines, x -> x.words >= {OWN_WORDS})").alias("lines")
    )
    anchor = F.explode(F.expr("array_distinct(flatten(transform(lines, x -> x.anchors)))")).alias("anchor")
    shared = long_lines.select("host", anchor).groupBy("host", "anchor").agg(F.count("*").alias("n_anchor"))
    shared = staged(shared.where(2 * F.col("n_anchor") >= MIN_DOCS), "anchors")
    each = long_lines.select("host", "text_key", F.explode("lines").alias("x")).select("host", "text_key", "x.line", F.explode("x.anchors").alias("anchor"))
    known = join_small(each, shared, ["host", "anchor"], "left")
    of_line = known.groupBy("host", "text_key", "line").agg(F.max(F.coalesce("n_anchor", F.lit(0))).alias("n_anchor"))
    own = staged(of_line.groupBy("host", "text_key").agg(F.min("n_anchor").alias("least")), "own")

    independent = F.coalesce(2 * F.col("least") < F.col("n"), F.lit(False))
    judged = join_small(uses, own, ["host", "text_key"], "left").groupBy("host", "line").agg(
        F.first("n_docs").alias("n_docs"), (F.count_if(independent) + F.max((~independent).cast("long"))).alias("documents")
    )
    return judged.where(_frequent("documents")).select("host", "line")


def _frequent(n: str) -> Column:
    return (F.col(n) >= MIN_DOCS) & ((100 * F.col(n) >= LIMIT_PERCENT * F.col("n_docs")) | (F.col(n) >= MANY_DOCS))


def judge(base: DataFrame) -> DataFrame:
    """host, text_key of every distinct text with frequent lines, these lines and its words in them."""
    texts = staged(distinct_texts(base), "texts")
    frequent = staged(frequent_lines(texts), "frequent")
    rows = texts.select("host", "text_key", F.explode("lines").alias("x")).select("host", "text_key", "x.line", "x.words")
    hits = join_small(rows, frequent, ["host", "line"], "inner").groupBy("host", "text_key")
    return staged(hits.agg(F.sum("words").alias("n_boilerplate_words"), F.collect_set("line").alias("boilerplate")), "verdicts")


def _kept() -> Column:
    """Of a row with its counts and, where its text has frequent lines, their words."""
    gone = F.coalesce(F.col("n_boilerplate_words"), F.lit(0))
    return ~base_failed() & (100 * (F.col("n_words") - gone) >= LEFT_PERCENT * F.col("n_words"))


def apply_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_boilerplate_words.

    One row for every row of ``docs``.  Null and empty texts have no words and fail.  ``source`` is the host;
    null is a host.  Rows equal in source and text share a verdict.
    """
    base = staged(base_counts(docs), "base")
    judged = join_small(base, judge(base).drop("boilerplate"), ["host", "text_key"])
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        _kept().alias("kept"),
        F.coalesce("n_boilerplate_words", F.lit(0)).alias("n_boilerplate_words"),
    )


def clean_documents(docs: DataFrame) -> DataFrame:
    """The documents that :func:`apply_rules` keeps, with their columns, without the frequent lines of their host.

    ``n_chars`` follows the text where ``docs`` has it.  Texts are not shuffled where the rejected and the changed ones are few.
    """
    base = staged(base_counts(docs), "base")
    verdicts = judge(base)
    judged = join_small(base.select("host", "text_key", "n_words", "n_repeat_words"), verdicts, ["host", "text_key"])
    names = {"host": "_host", "text_key": "_key", "boilerplate": "_lines"}
    gone = staged(judged.where(~_kept()).select("host", "text_key").distinct().withColumnsRenamed(names), "gone")
    changed = verdicts.select("host", "text_key", "boilerplate").withColumnsRenamed(names)
    on = (F.col("_host") == host()) & (F.col("_key") == text_key())
    line = _line_hash(_words("x"))
    text = F.when(F.col("_lines").isNull(), F.col("text")).otherwise(
        F.expr(rf"array_join(filter(split(text, '\\n'), x -> not array_contains(_lines, {line})), '\n')")
    )
    own = ["doc_id", "source", "text"]
    kept = join_small(carrying(docs, *own), gone, on, "left_anti")
    out = join_small(kept, changed, on).withColumn("text", text)
    return with_length(out.select(*unpacked(docs.columns, *own)), docs)


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, i, words[i:i + 2] AS gram FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
again AS (SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM g) WHERE c > 1) GROUP BY r),
v AS (SELECT r, host, text, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '') AS v
      FROM (SELECT r, host, text, unnest(lines) AS x FROM w JOIN d USING (r))),
l AS (SELECT r, host, text, lower(array_to_string(v, ' ')) AS line, len(v) AS n,
      CASE WHEN len(v) >= {OWN_WORDS} THEN [lower(array_to_string(v[k:k + 2], ' ')) for k in [1, 4, len(v) - 5, len(v) - 2]] END AS anchors FROM v),
h AS (SELECT host, count(DISTINCT text) AS n_docs FROM d GROUP BY host),
p AS (SELECT q.host, line, n, n_docs FROM (SELECT host, line, count(DISTINCT text) AS n FROM l GROUP BY ALL) q JOIN h ON h.host IS NOT DISTINCT FROM q.host
      WHERE n >= {MIN_DOCS} AND (100 * n >= {LIMIT_PERCENT} * n_docs OR n >= {MANY_DOCS})),
u AS (SELECT DISTINCT p.host, l.text, line, p.n, n_docs FROM l JOIN p USING (line) WHERE l.host IS NOT DISTINCT FROM p.host),
k AS (SELECT DISTINCT host, text, line, unnest(anchors) AS anchor FROM l WHERE anchors IS NOT NULL AND (host, text) IN (SELECT (host, text) FROM u)),
a AS (SELECT host, anchor, count(DISTINCT text) AS n FROM k GROUP BY ALL),
o AS (SELECT host, text, min(n) AS least FROM (SELECT k.host, text, line, max(n) AS n FROM k JOIN a USING (anchor)
      WHERE k.host IS NOT DISTINCT FROM a.host GROUP BY ALL) GROUP BY ALL),
f AS (SELECT u_host AS host, line, any_value(n_docs) AS n_docs, count_if(own) + max((NOT own)::INT) AS documents
      FROM (SELECT u.host AS u_host, line, n_docs, coalesce(2 * least < n, false) AS own FROM u LEFT JOIN o ON u.text = o.text AND u.host IS NOT DISTINCT FROM o.host) GROUP BY u_host, line
      HAVING documents >= {MIN_DOCS} AND (100 * documents >= {LIMIT_PERCENT} * any_value(n_docs) OR documents >= {MANY_DOCS})),
b AS (SELECT r, sum(n) AS n FROM l JOIN f USING (line) WHERE l.host IS NOT DISTINCT FROM f.host GROUP BY r),
c AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
      length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
      (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
      coalesce(again.n, 0) AS n_repeat_words, coalesce(b.n, 0)::BIGINT AS n_boilerplate_words
      FROM d JOIN w USING (r) LEFT JOIN again USING (r) LEFT JOIN b USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND 100 * (n_words - n_boilerplate_words) >= {LEFT_PERCENT} * n_words AS kept,
       n_boilerplate_words
FROM c
"""
