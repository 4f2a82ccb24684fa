"""Many-to-one joins that survive one key holding a large share of all rows.

The "one" side has a single row per key.  It also carries the set of salts
that occur for its key on the "many" side (a by-product of the aggregation
that built it), so it is repeated only as often as needed.  The join then runs
on (key, salt) and no task receives more than about 1/SALTS of a hot key.
Nothing is sampled or dropped, and it does not depend on adaptive execution.

Where a key's rows could have as many salts as rows, the salts of a key are in proportion to the rows it
holds (:func:`hot_keys`): the "one" side grows by less than ``HOT_KEYS`` rows in all, however the rows are spread
over keys.  Keys with a single salt are not even marked; the others are fewer than ``HOT_KEYS`` and broadcast as hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 1 << 14
HOT_KEYS = 10_000
SALT = "_salt"
HOT = "_hot"
WIDTH = "_width"
SALT_SET = "_salts"


def salt_of(*cols: Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(SALTS)).cast("int")


def salt_set(salt: Column, where: Column | None = None) -> Column:
    """Aggregate for the "one" side; at most ``SALTS`` integers per key."""
    return F.collect_set(salt if where is None else F.when(where, salt)).alias(SALT_SET)


def hot_keys(one: DataFrame, on: Sequence[str], rows: str) -> DataFrame:
    """Hash and number of salts of the keys that hold more than 1/``HOT_KEYS`` of the rows counted in column ``rows``.

    ``one`` is read twice, so it should be staged.
    """
    share = F.col(rows) * HOT_KEYS / one.agg(F.sum(rows)).scalar()
    hot = one.where(share > 1).groupBy(F.xxhash64(*on).alias(HOT))  # keys of equal hashes share their salts
    return hot.agg(F.max(F.ceil(share)).cast("int").alias(WIDTH))


def _widths(df: DataFrame, on: Sequence[str], hot: DataFrame) -> DataFrame:
    marked = df.withColumn("_hash", F.xxhash64(*on)).join(F.broadcast(hot), F.col("_hash") == F.col(HOT), "left")
    return marked.withColumn(WIDTH, F.coalesce(F.col(WIDTH), F.lit(1))).drop("_hash", HOT)


def salted(many: DataFrame, on: Sequence[str], hot: DataFrame, place: Column) -> DataFrame:
    """One of its key's salts for every row, by a hash of ``place``."""
    return _widths(many, on, hot).withColumn(SALT, F.pmod(F.xxhash64(place), F.col(WIDTH)).cast("int")).drop(WIDTH)


def with_salts(one: DataFrame, on: Sequence[str], hot: DataFrame) -> DataFrame:
    """All salts of the key of every row."""
    return _widths(one, on, hot).withColumn(SALT_SET, F.sequence(F.lit(0), F.col(WIDTH) - 1)).drop(WIDTH)


def join_spread(many: DataFrame, one: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``many`` (with a ``_salt`` column) to ``one`` (with ``_salts``)."""
    spread = one.withColumn(SALT, F.explode(SALT_SET)).drop(SALT_SET)
    return many.join(spread, [*on, SALT], how).drop(SALT)
