"""Duplicate hits: keep the first of each key, in arrival order.

A key may have any number of copies, so copies are never brought together as
rows.  Keys are aggregated (map-side combined) to their first position and
their number of copies, and only keys with more than one copy are joined back
to the rows, in two steps:

* keys that hold more than 1/``HOT_KEYS`` of all copies - so fewer than
  ``HOT_KEYS`` keys, however large the data - are broadcast, as two hashes and
  a position each;
* all other keys are joined normally; rows decided by the first step stay out
  of it or take part under a scattered hash, so that they stay spread out.

Rejects come from inner joins, so rows without copies are not shuffled beyond
what a Bloom filter lets through.  If there are few repeated keys at all, they
are broadcast as a whole and a plan that looks for other rejects as well finds
all of them in one scan (``quality.error_rows``).  Positions are compared
between two scans: hits of text files are staged with theirs first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.functions.text import stripped
from clicktrail.rules import Rules
from clicktrail.session import Staging
from clicktrail.sources.hits import with_stored_positions

HOT_KEYS = 10_000
# Repeated keys that are broadcast together: a count of them decides, at some 100 bytes each.
BROADCAST_KEYS = 200_000
_HASH = "_key_hash"
_HASHES = [_HASH, "_key_hash_2"]

Stage = Callable[[DataFrame], DataFrame]


def dedup_key(hits: DataFrame, rules: Rules) -> list[Column]:
    """Trimmed key values under fixed names; keys the file lacks are left out."""
    present = [c for c in rules.dedup_key_columns if c in hits.columns]
    return [F.coalesce(stripped(F.col(c)), F.lit("")).alias(f"_key_{c}") for c in present]


def _key_names(hits: DataFrame, rules: Rules) -> list[str]:
    return [f"_key_{c}" for c in rules.dedup_key_columns if c in hits.columns]


def _with_key(hits: DataFrame, rules: Rules, scope: Sequence[str]) -> DataFrame:
    """Rows with their key, and two hashes of it that stand for the key in joins: together 128 bits."""
    names = _key_names(hits, rules)
    keyed = hits.select("*", *dedup_key(hits, rules))
    return keyed.withColumns({h: F.xxhash64(F.lit(i), *scope, *names) for i, h in enumerate(_HASHES)})


def repeated_keys(hits: DataFrame, rules: Rules, scope: Sequence[str], stage: Stage) -> DataFrame:
    """Keys with more than one copy: two hashes, ``_first`` position and ``_copies``; staged, since it is read several times.

    The positions of the hits are stored.
    """
    rows = _with_key(hits, rules, scope)
    copies = rows.groupBy(*_HASHES).agg(F.min("pos").alias("_first"), F.count(F.lit(1)).alias("_copies"))
    return stage(copies.where(F.col("_copies") > 1))


def first_positions(hits: DataFrame, rules: Rules, repeated: DataFrame, valid: Column, scope: Sequence[str] = ()) -> DataFrame:
    """Rows with their key and, where the key is one of the (few) repeated ones, its ``_first`` position; nothing is shuffled.

    Rows that are not valid have no copies.
    """
    rows = _with_key(hits, rules, scope)
    rows = rows.withColumns({h: F.when(valid, F.col(h)) for h in _HASHES})
    return rows.join(F.broadcast(repeated.drop("_copies")), _HASHES, "left")


def _repeated(
    hits: DataFrame, rules: Rules, scope: Sequence[str], stage: Stage | None, repeated: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with keys, the hot repeated keys, and the other repeated keys, both with ``_first`` position."""
    stage = stage or Staging(hits.sparkSession, "repeated-keys")
    hits = with_stored_positions(hits, stage)
    rows = _with_key(hits, rules, scope)
    if repeated is None:
        repeated = repeated_keys(hits, rules, scope, stage)
    is_hot = F.col("_copies") * HOT_KEYS > repeated.agg(F.sum("_copies")).scalar()
    return rows, repeated.where(is_hot).drop("_copies"), repeated.where(~is_hot).drop("_copies")


def keep_first(hits: DataFrame, rules: Rules, scope: Sequence[str] = (), stage: Stage | None = None) -> DataFrame:
    """The first hit of every key, whole."""
    rows, hot, others = _repeated(hits, rules, scope, stage)
    hot = hot.withColumnRenamed("_first", "_hot_first")
    # The hash is one of the join keys: replacing it keeps decided rows apart from each other.
    scattered = F.when(F.col("_hot_first").isNotNull(), F.xxhash64("pos")).otherwise(F.col(_HASH))
    marked = rows.join(F.broadcast(hot), _HASHES, "left").withColumn(_HASH, scattered).join(others, _HASHES, "left")
    first = F.coalesce("_hot_first", "_first")
    return marked.where(first.isNull() | (first == F.col("pos"))).select(*hits.columns)


def keep_any(hits: DataFrame, rules: Rules) -> DataFrame:
    """Some hit of every key; one scan, for callers that do not care which copy survives."""
    keyed = hits.withColumns({name: c for name, c in zip(_key_names(hits, rules), dedup_key(hits, rules))})
    return keyed.dropDuplicates(_key_names(hits, rules)).select(*hits.columns)


def duplicate_reason(hits: DataFrame, rules: Rules) -> Column:
    """The reason of a later copy, for rows with their key."""
    names = _key_names(hits, rules)
    parts: list[Column] = [F.lit("duplicate_row: key=('")]
    for i, name in enumerate(names):
        parts += [F.lit("', '")] if i else []
        parts.append(F.col(name))
    return F.concat(*parts, F.lit("',)" if len(names) == 1 else "')"))


def duplicate_rejects(
    hits: DataFrame,
    rules: Rules,
    scope: Sequence[str] = (),
    stage: Stage | None = None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """All later copies, with the key they repeat; ``repeated`` are their keys where the caller has them."""
    reason = duplicate_reason(hits, rules)
    rows, hot, others = _repeated(hits, rules, scope, stage, repeated)
    of_hot = rows.join(F.broadcast(hot), _HASHES)
    of_others = rows.join(F.broadcast(hot.drop("_first")), _HASHES, "left_anti").join(others, _HASHES)
    later = F.col("_first") != F.col("pos")
    # Copies of a hot key often arrive together; spread, they are masked and written by all tasks.
    return of_hot.where(later).repartition(F.xxhash64("pos")).unionByName(of_others.where(later)).select(*hits.columns, reason.alias("_error_reason"))


def duplicate_counts(hits: DataFrame, rules: Rules) -> DataFrame:
    """Rows before and after dropping duplicates, without building either."""
    return hits.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_distinct(F.struct(*dedup_key(hits, rules))).alias("rows_after"),
    ).withColumn("duplicate_count", F.col("rows_before") - F.col("rows_after"))


def first_of_each(rows: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Keep-first for narrow rows in one aggregation; of the keys only ``keep`` stays.

    Cheaper than :func:`keep_first` when a row is only a few parsed values:
    one pass and one shuffle, with copies combined on the map side.  ``_repeated``
    is what :func:`repeated_keys` says of the key, and NULL if it has one copy.
    """
    values = [c for c in rows.columns if c not in keys]
    hashes = [F.xxhash64(F.lit(i), *keys).alias(h) for i, h in enumerate(_HASHES)]
    repeated = F.struct(*hashes, F.col("_row.pos").alias("_first"), F.col("_copies"))
    return (
        rows.groupBy(F.xxhash64(*keys).alias(_HASH), *keys)
        .agg(F.min_by(F.struct(*values), F.col("pos")).alias("_row"), F.count(F.lit(1)).alias("_copies"))
        .select(*keep, *[F.col(f"_row.{c}").alias(c) for c in values], F.when(F.col("_copies") > 1, repeated).alias("_repeated"))
    )
