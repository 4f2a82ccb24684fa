"""Fingerprints of documents from the terms of a middle band of document frequencies (I-Match).

Terms that nearly all documents have, or hardly any, say little.  The lexicon keeps those between; a text is the
sorted list of its distinct terms in the lexicon, and its signature a hash of that list.  So that few changed
words do not change everything, the list is also hashed within several random subsets of the lexicon, drawn so
thinly that about one of the text's terms is in each: how many of these hashes two texts share tells how
many terms they share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.store import staged
from clicktrail.llm.words import chunks, find_words, longs, mix, polynomial

#: Of the documents, how many a term of the lexicon is in: one in so many at least, and this share at most.
RAREST_ONE_IN = 2000
COMMONEST_PERCENT = 25
LEAST_DOCS = 2
#: The lexicon is small enough for every task.  Where more terms qualify the rarest go, by powers of two of their frequency.
LEXICON_TERMS = 1 << 20
SUBSETS = 32
COUNTED_BYTES = 4 << 20  # of text in which terms are counted together
BUCKET_BYTES = 8 << 20  # of text that is put in order by one task
MOST_BUCKETS = 20_000

_SEEDS = mix(np.arange(1, SUBSETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _distinct_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and term of each text's distinct terms, sorted."""
    found = find_words(texts, lower=True)
    terms, at = np.unique(found.hash, return_inverse=True)
    doc = np.repeat(np.arange(len(texts)), found.count())
    pairs = np.unique(doc * max(1, len(terms)) + at)
    return (pairs // len(terms), terms[pairs % len(terms)]) if len(terms) else (pairs, terms)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text", COUNTED_BYTES):
        terms, n = np.unique(_distinct_terms(batch.column("text"))[1], return_counts=True)
        yield pa.RecordBatch.from_arrays([longs(terms), pa.array(n.astype(np.int64))], names=["term", "n"])


def lexicon(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the terms whose document frequency lies in the band, counted over all rows.

    A document has few hundred to thousand distinct terms, so their mean times RAREST_ONE_IN bounds the lexicon
    whatever the number of documents; LEXICON_TERMS bounds it where texts are longer.
    """
    n_docs = docs.count()
    counts = docs.select("text").mapInArrow(_count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    band = counts.where((F.col("n") >= max(LEAST_DOCS, n_docs / RAREST_ONE_IN)) & (100 * F.col("n") <= COMMONEST_PERCENT * n_docs))
    band = staged(band.withColumn("power", F.floor(F.log2("n"))), "lexicon")
    total, least = 0, None
    for r in band.groupBy("power").count().orderBy(F.desc("power")).collect():  # 63 rows at most
        total += r["count"]
        if total > LEXICON_TERMS:
            break
        least = r["power"]
    if least is None:
        return np.zeros(0, np.uint64)
    terms = [b.column("term").to_numpy() for b in band.where(F.col("power") >= least).select("term").toArrow().to_batches()]
    return np.sort(np.concatenate(terms).view(np.uint64)) if terms else np.zeros(0, np.uint64)


class Prints:
    """Fingerprints of some texts: the signature, and the hashes in two layers of subsets; 0 where a subset has no term of the text."""

    def __init__(self, texts: list[str], known: np.ndarray):
        n = len(texts)
        doc, term = _distinct_terms(pa.array(texts, pa.string()))
        if len(known) and len(term):
            inside = known[np.minimum(np.searchsorted(known, term), len(known) - 1)] == term
            # A text without any term of the lexicon goes by all its terms.
            inside |= (np.bincount(doc[inside], minlength=n) == 0)[doc]
            doc, term = doc[inside], term[inside]
        count = np.bincount(doc, minlength=n)
        first = np.concatenate(([0], np.cumsum(count)))
        self.signature = np.where(count > 0, mix(polynomial(term, first[:-1], first[1:]) + np.uint64(1)), np.uint64(0))
        self.layer = np.array([max(0, int(c).bit_length() - 1) for c in count.tolist()], np.int64)
        self.hashes = np.zeros((n, 2, SUBSETS), np.uint32)
        values, at = np.unique(term, return_inverse=True)
        draws = mix(values[:, None] ^ _SEEDS[None, :])
        for k in (0, 1):
            thin = (np.uint64(1) << (self.layer[doc] + k).astype(np.uint64)) - np.uint64(1)
            row, subset = np.nonzero((draws[at] & thin[:, None]) == 0)
            if not len(row):
                continue
            # By text and subset; the terms of each stay sorted.
            key = doc[row] * SUBSETS + subset
            order = np.argsort(key, kind="stable")
            key, chosen = key[order], term[row[order]]
            head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            hashed = mix(polynomial(chosen, head, np.concatenate((head[1:], [len(key)]))) + np.uint64(2))
            self.hashes[key[head] // SUBSETS, k, key[head] % SUBSETS] = np.maximum(hashed >> np.uint64(40), np.uint64(1)).astype(np.uint32)

    def text(self, i: int) -> str:
        if not self.signature[i]:
            return ""
        return f"{int(self.signature[i]):016x}:{self.layer[i]}:" + "".join([f"{h:06x}" for h in self.hashes[i].ravel().tolist()])


def _alike(a: Prints, i: int, b: Prints, j: int) -> float:
    if a.signature[i] == b.signature[j]:
        return 1.0
    if not (a.signature[i] and b.signature[j]):
        return 0.0
    apart = int(b.layer[j] - a.layer[i])
    if abs(apart) > 1:
        return 0.0
    x, y = a.hashes[i], b.hashes[j]
    if apart:
        x, y = (x[1], y[0]) if apart > 0 else (x[0], y[1])
    both = int(np.count_nonzero(x | y))
    return float(np.count_nonzero((x == y) & (x > 0)) / both) if both else 0.0


def likeness(a: str, b: str) -> float:
    """From 0 to 1, the share of the subset hashes that two fingerprints have in common.

    Equal signatures are 1, an empty text is like empty ones only; texts of which one has more than about twice the
    terms of the other have no subset in common and are 0.
    """
    return _alike(_parsed(a), 0, _parsed(b), 0)


def _parsed(text: str) -> Prints:
    out = Prints([""], np.zeros(0, np.uint64))
    if text:
        signature, layer, hashes = text.split(":")
        out.signature[0], out.layer[0] = np.uint64(int(signature, 16)), int(layer)
        out.hashes[0] = np.array([int(hashes[k : k + 6], 16) for k in range(0, len(hashes), 6)], np.uint32).reshape(2, SUBSETS)
    return out


def fingerprints(docs: DataFrame, known: np.ndarray | None = None) -> DataFrame:
    """doc_id, fingerprint of every row of ``docs``, by a lexicon given or else by that of ``docs``.

    Equal texts have equal fingerprints; null and empty texts and texts without words have the empty one.
    """
    known = lexicon(docs) if known is None else known

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            found = Prints([t or "" for t in batch.column("text").to_pylist()], known)
            texts = pa.array([found.text(i) for i in range(batch.num_rows)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(prints, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one, or all of that."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(known: np.ndarray):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by bucket, those of the next bucket first, then by falling doc_id: so the next text was met before."""
        texts: list[str] = [""]  # of the chunk at hand, after the text that follows its first row
        rows: list[tuple[int | None, int, int]] = []  # doc_id, its text and the following one
        following, bucket, last, held = 0, None, None, 0

        def done() -> pa.RecordBatch:
            nonlocal texts, following, held, rows
            ours = Prints(texts, known)
            changed = [edited(texts[i], texts[j]) for _, i, j in rows]
            theirs = Prints(changed, known)
            columns = [
                pa.array([d for d, _, _ in rows], pa.int64()),
                pa.array([len(texts[i]) for _, i, _ in rows], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                pa.array([ours.text(i) for _, i, _ in rows], pa.string()),
                pa.array([theirs.text(k) for k in range(len(rows))], pa.string()),
                pa.array([_alike(ours, i, theirs, k) for k, (_, i, _) in enumerate(rows)], pa.float64()),
                pa.array([_alike(ours, i, ours, j) for _, i, j in rows], pa.float64()),
            ]
            # The text that follows, and the last one, which may follow the next row, go on.
            texts, following, held, rows = [texts[following], texts[-1]], 0, 0, []
            return pa.RecordBatch.from_arrays(columns, names=list(COLUMNS))

        for batch in batches:
            for b, ahead, doc, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "ahead", "doc_id", "text")), strict=True):
                if b != bucket:
                    bucket, last = b, None
                    texts.append("")
                    following = len(texts) - 1
                if not ahead and last is not None and doc != last[0]:
                    following = last[1]
                texts.append(text or "")
                held += len(texts[-1])
                if ahead:
                    following = len(texts) - 1
                else:
                    rows.append((doc, len(texts) - 1, following))
                    last = (doc, len(texts) - 1)
                if held >= 1 << 20:
                    yield done()
                    last = last and (last[0], 1)
        yield done()

    return compare


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _places(starts: np.ndarray):
    """The bucket of a doc_id, doubled; and for the first doc_id of a bucket the one before it, doubled plus 1."""

    def places(ids: pa.Array) -> pa.Array:
        ids = ids.to_numpy(zero_copy_only=False)
        at = np.searchsorted(starts, ids, side="right") - 1
        opens = starts[at] == ids
        ends = np.concatenate(([0], np.cumsum(1 + opens)))
        flat = np.zeros(ends[-1], np.int32)
        flat[ends[:-1]] = 2 * at
        flat[ends[1:][opens] - 1] = 2 * ((at[opens] - 1) % len(starts)) + 1
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))

    return F.arrow_udf(places, "array<int>")


def edit_likeness(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row of ``docs``.

    The edited text is the document's with its last half replaced by the beginning of the document that has the next
    doc_id; after the last comes the first.  Null and empty texts are empty, and like each other.  Of rows that repeat a
    doc_id the one of the least text hash stands for it where it is the next; all of them have the next doc_id as their
    next.  Rows with a null doc_id have no next document: what follows them is empty.  An empty table gives no rows.
    Other columns are not read.

    Rows are put in order in buckets between quantiles of doc_id; the first document of a bucket also goes to the bucket before
    it.  Only two texts of a bucket are held besides the chunk at hand.
    """
    known = lexicon(docs)
    rows = docs.select("doc_id", "text")
    placed = rows.where("doc_id is not null")
    size, low = docs.agg(F.sum(F.octet_length("text")), F.min("doc_id")).first()
    alone = rows.where("doc_id is null").selectExpr("0 as bucket", "false as ahead", "cast(doc_id as bigint) as doc_id", "text")
    alone = alone.mapInArrow(_alone(known), _SCHEMA)
    if low is None:
        return alone
    n = int(min(MOST_BUCKETS, max(1, -(-(size or 0) // bucket_bytes))))
    cuts = placed.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], max(10_000, 20 * n))).first()[0] if n > 1 else []
    starts = np.unique(np.array([low, *cuts], np.int64))
    dealt = placed.withColumn("place", F.explode(_places(starts)(F.col("doc_id").cast("long"))))
    dealt = dealt.selectExpr("shiftright(place, 1) as bucket", "place % 2 = 1 as ahead", "cast(doc_id as bigint) as doc_id", "text")
    order = [F.col("bucket"), F.desc("ahead"), F.desc("doc_id"), F.desc(F.xxhash64(F.coalesce("text", F.lit(""))))]
    dealt = dealt.repartition(len(starts), "bucket").sortWithinPartitions(*order)
    return dealt.mapInArrow(_compare(known), _SCHEMA).union(alone)


def _alone(known: np.ndarray):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compare = _compare(known)
        for batch in chunks(batches, "text"):
            # Every row opens a bucket, so nothing follows it.
            names = ["bucket", "ahead", "doc_id", "text"]
            columns = [pa.array(range(batch.num_rows), pa.int64()), *(batch.column(c) for c in names[1:])]
            yield from compare(iter([pa.RecordBatch.from_arrays(columns, names=names)]))

    return each
