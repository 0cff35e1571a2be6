"""Landing kept by day (or month), so that a look-back lists and reads its own days only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.functions.dates import lookback, lookback_start

DAY = "landed_day"


def _folder(time, grain: str):
    return F.to_date(time) if grain == "day" else F.trunc(F.to_date(time), grain)


def land_by_day(df: DataFrame, time_column: str, path: str, mode: str = "errorifexists", grain: str = "day") -> None:
    """Write ``df`` as Parquet, one folder a day of ``time_column`` (rows without a time: the null day).

    ``grain`` month, or another unit of ``trunc``, puts the days of a unit under its first one: for sources with few
    rows a day. Rows are dealt by ranges of time, so a task writes few folders and a large day is written by several tasks.
    """
    (df.withColumn(DAY, _folder(time_column, grain)).repartitionByRange(DAY, time_column)
     .write.mode(mode).partitionBy(DAY).parquet(path))


def read_window(spark: SparkSession, path: str, time_column: str, as_of: str, days: int | None, zone: str | None = None,
                grain: str = "day") -> DataFrame:
    """Rows of ``land_by_day`` (same ``grain``) from the last ``days`` before ``as_of`` on; ``days=None`` reads all.

    The window's first folder is a filter on the folders; the exact time is checked on the rows.
    """
    landed = spark.read.parquet(path)
    if days is None:
        return landed
    first = _folder(lookback_start(as_of, days, zone), grain)
    return landed.filter((F.col(DAY) >= first) & lookback(time_column, as_of, days, zone))
