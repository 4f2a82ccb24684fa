"""Personal data: fixed patterns, and more spans by weak supervision.

Wider patterns propose candidates.  Labelers vote on each for, against or not at all: its shape (regular
expressions), lists of words and prefixes (gazetteer) and the words beside it (context).  Expectation
maximisation estimates from the counts of all vote patterns how reliable each labeler is, and its
posteriors train a logistic classifier of features that decides which candidates are spans.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.store import carrying, join_small, staged, unpacked, with_length
from clicktrail.llm.words import chunks

# The base kinds in their order, and the character classes of their patterns.
BASE_KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

#: Kinds of added spans, in the order in which they follow the base kinds.
ADDED_KINDS = ("secret", "account", "local_phone", "ssn", "iban", "spelt_email")
CONTEXT_CHARS = 40
ACCEPTED = 0.5
ROUNDS = 100

_CANDIDATES = {
    "secret": re.compile(r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{20,}+"),
    "account": re.compile(r"(?<![0-9.+-])[0-9](?:[\x20-]?[0-9]){11,18}(?![0-9.-])"),
    "local_phone": re.compile(r"(?<![0-9+)(] )(?<![0-9+(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "spelt_email": re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,64}+ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]+ ?[\[(] ?dot ?[\])] ?[A-Za-z]{2,10}\b"),
}
# Gazetteers: words beside personal data and beside harmless numbers, card issuers' first digits, domain ends.
_CUES = {
    "secret": ("token", "secret", "password", "passwd", "api_key", "apikey", "api key", "auth", "bearer", "credential"),
    "account": ("account", "card", "visa", "iban", "konto", "compte", "cuenta", "tarjeta", "carte", "karte"),
    "local_phone": ("phone", "call", "tel", "mobile", "cell", "fax", "contact", "telefon", "téléphone", "teléfono"),
    "ssn": ("ssn", "social security", "taxpayer", "tax id"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "spelt_email": ("mail", "contact", "write", "reach", "correo", "courriel"),
}
_HARMLESS = ("commit", "sha", "md5", "checksum", "digest", "isbn", "issn", "doi", "version", "build", "revision", "order", "invoice", "serial", "http")
_ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65")
_ENDS = ("com", "org", "net", "edu", "gov", "de", "fr", "es", "uk", "io", "info")
LABELERS = ("shape", "checksum", "gazetteer", "context", "harmless")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """The leftmost matches that do not overlap; each is found from its @, so a long word costs one look."""
    out, done = [], 0
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        if at < done:
            continue
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at:
            out.append((start, m.end()))
            done = m.end()
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base kinds, by kind, then start."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return out


def _iban(s: str) -> bool:
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def votes(kind: str, span: str, before: str, after: str) -> tuple[int, ...]:
    """What each labeler says of a candidate: 1 for, -1 against, 0 nothing."""
    digits = "".join(_DIGIT.findall(span))
    shape = {
        "secret": 1 if re.fullmatch(r"[0-9a-f]{32,}|(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])[A-Za-z0-9_-]{24,}", span) else -1 if len(digits) < 4 else 0,
        "account": 1 if len(digits) == 16 else 0,
        "local_phone": 1 if span[0] == "(" or span.count("-") == 2 else 0,
        "ssn": 1,
        "iban": 1 if len(span.replace(" ", "")) >= 15 else -1,
        "spelt_email": 1,
    }[kind]
    checksum = 0
    if kind == "account":
        checksum = 1 if luhn(digits) else -1
    elif kind == "iban":
        checksum = 1 if _iban(span) else -1
    elif kind == "ssn":
        checksum = -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" else 0
    elif kind == "secret":
        counts = np.unique(list(span), return_counts=True)[1] / len(span)
        checksum = 1 if -(counts * np.log2(counts)).sum() > 3.2 else -1
    gazetteer = 0
    if kind == "account":
        gazetteer = 1 if digits.startswith(_ISSUERS) else -1
    elif kind == "spelt_email":
        gazetteer = 1 if span.rsplit(None, 1)[-1].strip("[]() ").lower().endswith(_ENDS) else -1
    elif kind == "secret":
        gazetteer = 1 if before.rstrip().endswith(('= "', "= '", '="', "='", ': "', '"')) and after[:1] in "\"'" else 0
    around = before.lower()
    context = 1 if any(w in around for w in _CUES[kind]) else 0
    harmless = -1 if any(w in around for w in _HARMLESS) else 0
    return shape, checksum, gazetteer, context, harmless


def features(kind: str, span: str, seen: tuple[int, ...]) -> tuple[int, ...]:
    """What the classifier sees: the kind, the votes for and against, the length and how much of it is digits."""
    share = sum(c.isdigit() for c in span) / len(span)
    return (ADDED_KINDS.index(kind), *seen, min(3, len(span) // 16), int(4 * share))


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, features) of the candidates beside the base spans, each place of the first kind that has it."""
    if not _DIGIT.search(text) and "at" not in text:
        return []
    starts: list[int] = []  # of what is taken, in order and apart
    ends: list[int] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if ends and a < ends[-1]:
            ends[-1] = max(b, ends[-1])
        else:
            starts.append(a)
            ends.append(b)
    out = []
    for kind, pattern in _CANDIDATES.items():
        for m in pattern.finditer(text):
            a, b = m.span()
            k = bisect_left(starts, b)
            if k and ends[k - 1] > a:
                continue
            starts.insert(k, a)
            ends.insert(k, b)
            seen = votes(kind, m[0], text[max(0, a - CONTEXT_CHARS) : a], text[b : b + 2])
            out.append((kind, a, b, ",".join(map(str, features(kind, m[0], seen)))))
    return out


def reliabilities(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expectation maximisation over vote patterns (rows) that occur ``counts`` times.

    Returns the posterior of each pattern and P(vote | class) by labeler, class and vote (-1, 0, 1).
    It starts from the majority; one added count for each vote keeps rare patterns from certainty.
    """
    posterior = 1 / (1 + np.exp(-1.5 * patterns.sum(1)))
    table = np.zeros((patterns.shape[1], 2, 3))
    for _ in range(ROUNDS):
        before = posterior
        weight = np.stack([(1 - posterior) * counts, posterior * counts])
        prior = (weight.sum(1) + 1) / (counts.sum() + 2)
        for j in range(patterns.shape[1]):
            for v in (-1, 0, 1):
                table[j, :, v + 1] = weight[:, patterns[:, j] == v].sum(1) + 1
        table /= table.sum(2, keepdims=True)
        log = np.log(prior)[:, None] + sum(np.log(table[j][:, patterns[:, j] + 1]) for j in range(patterns.shape[1]))
        posterior = 1 / (1 + np.exp(np.clip(log[0] - log[1], -30, 30)))
        if np.abs(posterior - before).max() < 1e-6:
            break
    return posterior, table


def train(rows: list[tuple[str, int]]) -> dict[str, float]:
    """The score of each feature pattern, from all patterns and their counts."""
    if not rows:
        return {}
    x = np.array([list(map(int, p.split(","))) for p, _ in rows])
    counts = np.array([float(n) for _, n in rows])
    posterior, _ = reliabilities(x[:, 1 : 1 + len(LABELERS)], counts)
    hot = [np.ones(len(x))]
    for j in range(x.shape[1]):
        hot += [(x[:, j] == v).astype(float) for v in np.unique(x[:, j])]
    a = np.stack(hot, axis=1)
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hessian = (a.T * (counts * p * (1 - p))) @ a + np.eye(a.shape[1])
        step = np.linalg.solve(hessian, a.T @ (counts * (posterior - p)) - w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return {rows[i][0]: 1 / (1 + math.exp(-max(-30.0, min(30.0, float(s))))) for i, s in enumerate(a @ w)}


def _text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_FOUND = "base string, n array<long>, added array<struct<kind:string,start:long,end:long,pattern:string>>"


def _find(keep: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    added = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("pattern", pa.string())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            base, n, more = [], [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                base.append(_text(spans))
                n.append([sum(k == kind for k, *_ in spans) for kind in BASE_KINDS])
                more.append([dict(zip(("kind", "start", "end", "pattern"), c, strict=True)) for c in candidates(text or "", spans)])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(base, pa.string()), pa.array(n, pa.list_(pa.int64())), pa.array(more, added)],
                names=[*keep, "base", "n", "added"],
            )

    return find


def _rank(kind):
    out = F.lit(len(ADDED_KINDS))
    for i, k in enumerate(ADDED_KINDS):
        out = F.when(kind == k, i).otherwise(out)
    return out.alias("rank")


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base, n and ``more``: the spans of every row of ``docs``, base ones and those of the classifier.

    All candidates of all documents take part in the estimates; their feature patterns are a fixed, small number
    of combinations, so the counts fit on the driver.  Null and empty texts have no spans.  Repeated rows each
    have theirs.
    """
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    found = staged(rows.mapInArrow(_find(["doc_id", "text_key"]), f"doc_id long, text_key long, {_FOUND}"), "spans")
    counts = found.select(F.explode("added.pattern").alias("pattern")).groupBy("pattern").count()
    scores = train(sorted((r.pattern, r["count"]) for r in counts.collect()))
    good = F.array(*[F.lit(p) for p, s in sorted(scores.items()) if s >= ACCEPTED]).cast("array<string>")
    more = F.array_sort(
        F.transform(
            F.filter("added", lambda x: F.array_contains(good, x["pattern"])),
            lambda x: F.struct(_rank(x["kind"]), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")),
        )
    )
    return found.select("doc_id", "text_key", "base", "n", more.alias("more"))


def spans_of(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row of ``docs``."""
    found = find_spans(docs)
    more = F.transform("more", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    parts = F.concat(F.when(F.col("base") != "", F.array("base")).otherwise(F.array().cast("array<string>")), more)
    return found.select(
        "doc_id",
        *[F.col("n")[i].alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)],
        F.sha2("base", 256).alias("base_sha256"),
        F.array_join(parts, ",").alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; n_chars follows the text where there is one.

    Rows equal in doc_id and text share their spans.  Rows without spans are left as they are.
    """
    found = find_spans(docs).where("base != '' or size(more) > 0").dropDuplicates(["doc_id", "text_key"])
    both = F.concat(
        F.expr("transform(filter(split(base, ','), x -> x != ''), x -> named_struct('start', cast(split(x, ':')[1] as bigint),"
               " 'end', cast(split(x, ':')[2] as bigint), 'kind', split(x, ':')[0]))"),
        F.transform("more", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))),
    )
    spans = staged(found.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), F.array_sort(both).alias("_spans")), "redact")
    on = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_key"))
    # From left to right: what lies between the spans stays; overlapping spans become one, named by the first.
    text = F.expr(
        "aggregate(_spans, named_struct('out', '', 'at', 0L), (a, s) -> if(s.start >= a.at,"
        " named_struct('out', concat(a.out, substring(text, cast(a.at + 1 as int), cast(s.start - a.at as int)), '[', upper(s.kind), ']'), 'at', s.end),"
        " named_struct('out', a.out, 'at', greatest(a.at, s.end))),"
        " a -> concat(a.out, substring(text, cast(a.at + 1 as int))))"
    )
    names = ["doc_id", "text"]
    out = join_small(carrying(docs, *names), spans, on)
    out = out.withColumn("text", F.when(F.col("_spans").isNotNull(), text).otherwise(F.col("text")))
    return with_length(out.select(*unpacked(docs.columns, *names)), docs)
