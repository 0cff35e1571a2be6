"""Equi-joins that stay even when one key holds a large share of the rows.

A sort-merge full outer join cannot be split by AQE, and in any join a key that
is hot on both sides multiplies inside one task. Here rows are counted first: per
bucket of the keys' hash, then per key in the buckets that hold enough rows for a
heavy one, so keys are shuffled to be counted only where one may be heavy. A key with more than ``HEAVY_ROWS`` rows on a
side gets that side dealt into so many slices; each row of one side takes one
of its side's slices and meets every slice of the other side, so each pair of
rows meets exactly once, in one of slices x slices tasks. All other keys have one
slice. It is one join, whatever the data; only the number of slices follows the counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a key that one task may take from one side.
HEAVY_ROWS = 500_000
#: The heaviest keys that are dealt into slices; the list is broadcast, so its length is bounded.
HEAVY_KEYS = 10_000
#: Buckets of the keys' hash that rows are first counted by: a counting task sends at most so many rows.
COUNT_BUCKETS = 16_384
#: Slices of a side stay under this; a place holds one number of either side.
_SIDE = 1 << 31


def _key(df: DataFrame, key: str | Column) -> Column:
    return df[key] if isinstance(key, str) else key


def heavy_keys(left: DataFrame, right: DataFrame, left_keys: list, right_keys: list,
               heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Keys with more than ``heavy_rows`` rows on a side: key columns ``__h0..``,
    ``__ls`` and ``__rs`` (slices of each side) and ``__both`` (both sides have rows).
    At most ``HEAVY_KEYS`` rows; null is a key like any other.

    A heavy key makes its bucket heavy, so the exact count needs the rows of heavy buckets only;
    usually there are none. With so many rows that every bucket is heavy it counts all rows."""
    names = [f"__h{i}" for i in range(len(left_keys))]

    def counted(keys: list[str], rows: DataFrame) -> DataFrame:
        n = rows.groupBy(*keys).agg(F.sum("__l").alias("nl"), F.sum("__r").alias("nr"))
        return n.filter((F.col("nl") > heavy_rows) | (F.col("nr") > heavy_rows))

    def keyed(df: DataFrame, keys: list, is_left: int) -> DataFrame:
        return df.select(*[_key(df, k).alias(n) for k, n in zip(keys, names)],
                         F.lit(is_left).cast("long").alias("__l"), F.lit(1 - is_left).cast("long").alias("__r"))

    rows = (keyed(left, left_keys, 1).unionByName(keyed(right, right_keys, 0))
            .withColumn("__b", F.pmod(F.xxhash64(*names), F.lit(COUNT_BUCKETS)).cast("int")))
    full = counted(["__b"], rows).select(F.col("__b").alias("__full"))
    slices = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / heavy_rows)).cast("int")
    return (counted(names, rows.join(F.broadcast(full), F.col("__b") == F.col("__full")))
            .orderBy(F.greatest("nl", "nr").desc(), *names).limit(HEAVY_KEYS)
            .select(*names, slices("nl").alias("__ls"), slices("nr").alias("__rs"),
                    ((F.col("nl") > 0) & (F.col("nr") > 0)).alias("__both")))


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _sliced(df: DataFrame, keys: list, heavy: DataFrame, own: str, other: str, place: str) -> DataFrame:
    """Rows with their ``place``, once for every slice of the other side.

    The place is one number, so that a row carries little to the join: the row's slice if the other
    side has no such key (0 if the key is not heavy), else, below zero, left slice and right slice.
    A row's slice is drawn from its values and its partition, so a recomputed
    task deals its rows alike, and equal rows of several partitions part.
    """
    names = [c for c in heavy.columns if c.startswith("__h")]
    cols = [F.col(f"`{c}`") for c in df.columns]
    tagged = df.join(F.broadcast(heavy), _all(_key(df, k).eqNullSafe(heavy[n]) for k, n in zip(keys, names)), "left")
    draw = F.pmod(F.xxhash64(*cols, F.spark_partition_id()), F.coalesce(F.col(own), F.lit(1)).cast("long"))
    copies = F.when(F.col("__both"), F.col(other)).otherwise(F.lit(1))  # alone: nothing to meet
    dealt = tagged.select(*cols, F.coalesce("__both", F.lit(False)).alias("__both"), draw.alias("__own"),
                          F.explode(F.sequence(F.lit(0), copies - 1)).alias("__other"))
    left, right = ("__own", "__other") if own == "__ls" else ("__other", "__own")
    met = -(F.col(left).cast("long") * F.lit(_SIDE) + F.col(right) + 1)
    return dealt.select(*cols, F.when(F.col("__both"), met).otherwise(F.col("__own")).alias(place))


def skew_join(left: DataFrame, right: DataFrame, left_keys: list, right_keys: list, how: str = "inner",
              null_safe: bool = False, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``left`` joined to ``right`` where the keys are equal, ``how`` inner or full_outer.

    Keys are column names or Columns bound to their side. ``null_safe``: null keys equal each other,
    else they match nothing. The two sides' column names must be disjoint. All columns of both
    sides are returned.
    """
    if how not in ("inner", "full_outer"):
        raise ValueError(f"inner or full_outer, not {how}")
    heavy = heavy_keys(left, right, left_keys, right_keys, heavy_rows)
    if not null_safe:  # a null key meets nothing: its rows are dealt out without copies
        whole = _all(F.col(c).isNotNull() for c in heavy.columns if c.startswith("__h"))
        heavy = heavy.withColumn("__both", F.col("__both") & whole)
    sl = _sliced(left, left_keys, heavy, "__ls", "__rs", "__li")
    sr = _sliced(right, right_keys, heavy, "__rs", "__ls", "__rj")
    pairs = [(_key(sl, a), _key(sr, b)) for a, b in zip(left_keys, right_keys)]
    equal = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    met = sl.join(sr, _all([*equal, sl["__li"] == sr["__rj"]]), how)
    if how == "full_outer":
        # A key that both sides have leaves no row alone; a copy that met an empty slice is not one.
        copied = F.coalesce("__li", "__rj") < 0
        met = met.filter(~copied | (F.col("__li").isNotNull() & F.col("__rj").isNotNull()))
    return met.select(*[F.col(f"`{c}`") for c in left.columns + right.columns])
