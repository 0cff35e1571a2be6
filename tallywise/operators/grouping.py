"""Per-group row choices expressed as aggregates, not sorts.

Aggregates run a partial (map-side) step before the shuffle, so a hot key
costs one small partial row per task instead of a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_non_null(value: str, order: str, alias: str | None = None) -> Column:
    """Aggregate: the value with the smallest ``order`` among non-null values."""
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order))).alias(alias or value)


def first_row_per_group(df: DataFrame, keys, order: str, cols=None) -> DataFrame:
    """Keep the row with the smallest ``order`` per key (pandas keep='first')."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = [c for c in (cols or df.columns) if c not in keys]
    picked = F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(order)).alias("__row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in cols])


def last_wins(df: DataFrame, keys, order: str, cols=None) -> DataFrame:
    """Keep the row with the largest ``order`` per key (later record wins)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = [c for c in (cols or df.columns) if c not in keys]
    picked = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(order)).alias("__row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in cols])


def flag_first_in_group(df: DataFrame, key: str, order: str, flag: str = "is_first") -> DataFrame:
    """Add ``flag`` = row has the smallest ``order`` within its ``key``.

    The per-key minimum is an aggregate; it is joined back on (key, order), so
    the join is hashed on both columns and a hot key spreads over partitions.
    Null keys form one group, as in pandas ``duplicated``.
    """
    firsts = (df.groupBy(key).agg(F.min(order).alias("__min_order"))
              .select(F.col(key).alias("__k"), F.col("__min_order"), F.lit(True).alias("__hit")))
    joined = df.join(firsts, df[key].eqNullSafe(firsts["__k"]) & (df[order] == firsts["__min_order"]), "left")
    return (joined.withColumn(flag, F.coalesce(F.col("__hit"), F.lit(False)))
            .drop("__k", "__min_order", "__hit"))


HOT_GROUP_ROWS = 1_000_000


def _materialize(df: DataFrame) -> DataFrame:
    """Positions derived from partition ids must be computed once: a second
    evaluation could see a different partition layout."""
    from tallywise.session import stage_rows
    return stage_rows(df, "positions")


def number_within_group(df: DataFrame, keys, order_cols, out: str = "line_no",
                        hot_threshold: int | None = HOT_GROUP_ROWS, partitions: int | None = None) -> DataFrame:
    """Sequential number from 1 per group, in the given (total) order.

    A first aggregate job counts rows per group (map-side combined). Groups
    up to ``hot_threshold`` rows are numbered with a window. Larger
    (hot) groups would put a whole group into one task, so their rows are
    range-partitioned on (keys, order) across many tasks and numbered by
    position: partition offsets (one row per partition) plus the position
    within the partition, minus the group's first position. Both helper
    tables are bounded (partitions; hot keys <= rows / threshold) and are
    broadcast.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    if hot_threshold is None:
        return df.withColumn(out, F.row_number().over(w).cast("bigint"))

    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot_keys = sizes.filter(F.col("__n") > hot_threshold).select(*keys)
    if hot_keys.isEmpty():  # the usual case: every group fits one task
        return df.withColumn(out, F.row_number().over(w).cast("bigint"))
    cols = df.columns
    key_match = [F.col(f"d.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
    cond = key_match[0]
    for c in key_match[1:]:
        cond = cond & c
    hk = F.broadcast(hot_keys).alias("h")
    normal = df.alias("d").join(hk, cond, "left_anti")
    hot = df.alias("d").join(hk, cond, "left_semi")

    numbered = normal.withColumn(out, F.row_number().over(w).cast("bigint"))

    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = _materialize(hot.repartitionByRange(n, *[F.col(k) for k in keys], *order_cols)
                           .sortWithinPartitions(*[F.col(k) for k in keys], *order_cols)
                           .withColumn("__pid", F.spark_partition_id())
                           .withColumn("__pos", F.monotonically_increasing_id()
                                       - F.shiftleft(F.col("__pid").cast("bigint"), 33)))
    per_part = ordered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    offsets = per_part.select(
        "__pid", (F.sum("__cnt").over(Window.orderBy("__pid")) - F.col("__cnt")).alias("__off"))
    placed = ordered.join(F.broadcast(offsets), "__pid").withColumn("__g", F.col("__off") + F.col("__pos"))
    starts = placed.groupBy(*keys).agg(F.min("__g").alias("__start"))
    skeys = [F.col(f"p.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    scond = skeys[0]
    for c in skeys[1:]:
        scond = scond & c
    hot_numbered = (placed.alias("p").join(F.broadcast(starts).alias("s"), scond)
                    .select(*[F.col(f"p.{c}") for c in cols],
                            (F.col("p.__g") - F.col("s.__start") + 1).cast("bigint").alias(out)))
    return numbered.unionByName(hot_numbered)


def dense_index(df: DataFrame, order_cols, out: str = "id", start: int = 1) -> DataFrame:
    """Dense sequential key in a total order, without a single-task window.

    Rows are range-partitioned and sorted; each row's key is its partition's
    offset (a cumulative count over one row per partition, broadcast) plus
    its position within the partition.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    cols = df.columns
    ordered = _materialize(df.orderBy(*order_cols)
                           .withColumn("__pid", F.spark_partition_id())
                           .withColumn("__pos", F.monotonically_increasing_id()
                                       - F.shiftleft(F.col("__pid").cast("bigint"), 33)))
    per_part = ordered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    offsets = per_part.select("__pid", (F.sum("__cnt").over(Window.orderBy("__pid")) - F.col("__cnt")).alias("__off"))
    return (ordered.join(F.broadcast(offsets), "__pid")
            .select((F.col("__off") + F.col("__pos") + F.lit(start)).cast("bigint").alias(out), *cols))
