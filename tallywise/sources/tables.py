"""Loading the driver's parquet tables.

Every reader returns a lazy DataFrame over the parquet file, so projections
and filters written later reach the scan (``PushedFilters`` / ``ReadSchema``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the parquet tables as temp views under their own names."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
