"""Repeat documents so that sources reach target shares of the bytes.

A source's mean number of repetitions is its target bytes over its bytes.  Each
document draws its count by inverting the Poisson distribution of that mean at a
number hashed from the document and a seed, is exploded by it, and lands in a
random place of a random partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.llm.store import carrying, join_small, staged, unpacked

TEMPERATURE = 0.5
SEED = 17
#: SQL of the first count that has any weight in doubles; from 1 or from 24 on, where the series below holds.
FIRST = "case when rate - 12 * sqrt(rate) < 50 then 1 else cast(floor(rate - 12 * sqrt(rate) - 25) as bigint) end"
#: SQL of the logarithm of the factorial of first - 1, by Stirling's series; of 0 it is 0.
LOG_FACTORIAL = (
    "case when first = 1 then 0.0 else (first - 1) * ln(cast(first - 1 as double)) - (first - 1) + 0.5 * ln(2 * pi() * (first - 1))"
    " + 1 / (12 * cast(first - 1 as double)) - 1 / (360 * pow(cast(first - 1 as double), 3)) + 1 / (1260 * pow(cast(first - 1 as double), 5)) end"
)


def _unit(*parts: Column) -> Column:
    """A long below 2**52 hashed from the parts; null parts count as ``-``."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def repetition_rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """source, bytes, rate and the distribution function of the count from ``first`` on, one row for each source.

    Without ``weights`` a source's weight is its bytes to the power ``temperature``; sources that
    ``weights`` doesn't name get none.  The null source is a source.
    """
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long") + 1
    sizes = docs.groupBy("source").agg(F.sum(size).alias("bytes"))
    if weights is None:
        weight = F.sqrt(F.col("bytes").cast("double")) if temperature == 0.5 else F.pow(F.col("bytes").cast("double"), F.lit(temperature))
    else:
        # The names are an argument, as few as the caller has written down.
        weight = F.coalesce(*[F.when(F.col("source") == k, F.lit(float(v))) for k, v in weights.items()], F.lit(0.0))
    sizes = sizes.withColumn("weight", weight)
    whole = Window.partitionBy()  # over sources, not documents
    rates = sizes.select(
        "source",
        "bytes",
        (F.sum("bytes").over(whole) * F.col("weight") / F.sum("weight").over(whole) / F.col("bytes")).alias("rate"),
    )
    # Beyond 12 standard deviations and 25 more nothing is left of the distribution in doubles.
    spread = rates.where("rate > 0").withColumn("first", F.expr(FIRST)).withColumn("before", F.expr(LOG_FACTORIAL))
    k = spread.withColumn("k", F.explode(F.expr("sequence(first, cast(ceil(rate + 12 * sqrt(rate) + 25) as bigint))")))
    upto = Window.partitionBy("source").orderBy("k")
    logs = k.withColumn("log_p", F.col("k") * F.ln("rate") - F.col("rate") - (F.col("before") + F.sum(F.ln(F.col("k").cast("double"))).over(upto)))
    sums = logs.withColumn("below", F.exp(-F.col("rate")) + F.coalesce(F.sum(F.exp("log_p")).over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    # The chance of fewer than k, for k = first, first + 1, ...: so many of these as lie at or below the draw are added to first - 1.
    cdf = sums.groupBy("source").agg(F.min("first").alias("first"), F.array_sort(F.collect_list("below")).alias("cdf"))
    cdf = cdf.withColumnRenamed("source", "_of")
    return rates.join(cdf, F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of")


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` as often as it was drawn, with ``copy`` (from 1) and ``order_key``, globally shuffled.

    Null and empty texts count one byte.  Rows equal in ``doc_id`` and text draw the same count, each of
    them.  A null source is mixed like any other; an empty table stays empty.  Columns of ``docs``
    named ``copy`` or ``order_key`` are replaced.
    """
    rates = staged(repetition_rates(docs, weights).select(F.col("source").alias("_source"), F.col("first").alias("_first"), F.col("cdf").alias("_cdf")), "rates")
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")))
    docs = docs.drop("copy", "order_key")
    names = ["doc_id", "source", "text"]
    drawn = carrying(docs, *names).withColumns({"_digest": digest, "_scan": F.monotonically_increasing_id()})
    drawn = join_small(drawn, rates, F.col("source").eqNullSafe(F.col("_source")))
    drawn = drawn.withColumn("_u", _unit(F.lit(seed), F.col("doc_id"), F.col("_digest")) / F.lit(float(2**52)))
    copies = drawn.withColumn("_n", F.expr("cast(coalesce(_first - 1 + size(filter(_cdf, c -> c <= _u)), 0) as int)")).where("_n > 0")
    copies = copies.withColumn("copy", F.explode(F.expr("sequence(1, _n)")))
    copies = copies.withColumn("order_key", _unit(F.lit(seed + 1), F.col("doc_id"), F.col("_digest"), F.col("copy")))
    # The place in the scan deals out rows that are equal in everything else.
    key = F.xxhash64("order_key", "_scan")
    shuffled = copies.select(*names, "carried", "copy", "order_key", key.alias("_key"))
    shuffled = shuffled.repartition("_key").sortWithinPartitions("order_key", "_key")
    return shuffled.select(*unpacked(docs.columns, *names), "copy", "order_key")


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS row_number, doc_id, source, strlen(coalesce(text, '')) + 1 AS size, md5(coalesce(text, '')) AS digest FROM documents),
s AS (SELECT source, sum(size) AS bytes FROM d GROUP BY source),
r AS (SELECT source, sum(bytes) OVER () * sqrt(bytes::DOUBLE) / sum(sqrt(bytes::DOUBLE)) OVER () / bytes AS rate FROM s),
e AS (SELECT source, rate, {FIRST} AS first FROM r WHERE rate > 0),
k AS (SELECT source, rate, first, {LOG_FACTORIAL} AS before, unnest(range(first, ceil(rate + 12 * sqrt(rate) + 25)::BIGINT + 1)) AS k FROM e),
p AS (SELECT source, rate, k, first, exp(k * ln(rate) - rate - (before + sum(ln(k::DOUBLE)) OVER (PARTITION BY source ORDER BY k))) AS p FROM k),
c AS (SELECT source, k, first, exp(-rate) + coalesce(sum(p) OVER (
    PARTITION BY source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM p),
u AS (SELECT *, ('0x' || md5('{SEED}|' || coalesce(doc_id::VARCHAR, '-') || '|' || digest)[:13])::BIGINT / 4503599627370496.0::DOUBLE AS u
      FROM d),
n AS (SELECT u.doc_id, u.source, digest, unnest(range(1, min(first) + count(*))) AS k FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source
      AND c.below <= u.u GROUP BY row_number, u.doc_id, u.source, digest)
SELECT doc_id, source, k::INTEGER AS copy,
       ('0x' || md5('{SEED + 1}|' || coalesce(doc_id::VARCHAR, '-') || '|' || digest || '|' || k)[:13])::BIGINT AS order_key FROM n
"""
