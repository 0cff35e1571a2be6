"""Sinks: full table replace, write-once, reports, load stamps.

All written paths live under the shared folder named by
``spark.checkpoint.dir`` (see tallywise.session.scratch_path) unless the
caller passes its own location.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.operators import dense_index
from tallywise.session import scratch_path
from tallywise.sources.files import file_system, path_exists
from tallywise.sources.versions import POINTER, replace_tables


def keyed_rows(df: DataFrame, order_cols, key: str = "id", as_text: bool = True) -> DataFrame:
    """Text columns (as the landing tables are declared) and a dense surrogate key in source order."""
    cols = df.columns
    keyed = dense_index(df.withColumn("__o", F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_cols])), ["__o"], key)
    text = [F.col(f"`{c}`").cast("string").alias(c) for c in cols] if as_text else [F.col(f"`{c}`") for c in cols]
    return keyed.select(*text, key)


def replace_table(df: DataFrame, path: str, order_cols, key: str = "id", as_text: bool = True) -> None:
    """Full replace in one step (see ``sources.versions``): readers see the old rows
    until all new ones are written. Read it back with ``versions.read_table``."""
    replace_tables({"data": keyed_rows(df, order_cols, key, as_text)}, path)


def insert_by_name(df: DataFrame, target_columns) -> DataFrame:
    """Align a frame to a target column list by name (absent -> null)."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in have else F.lit(None).cast("string").alias(c)
                       for c in target_columns])


#: A claim on a load is taken over from a load that has not ended after so long.
LEASE_SECONDS = 6 * 3600


def claim(spark: SparkSession, path: str, lease_seconds: float = LEASE_SECONDS) -> str | None:
    """Claim the load of ``path``; the claim file's path, or None where another load holds it.

    The claim is a file beside the target, created only if absent, which one
    of several loads can do where the store creates atomically (HDFS; local folders
    through the operating system). A claim older than the lease belongs to a
    load that died; it is moved aside first, which one of several can do, too.
    """
    mark = f"{path.rstrip('/')}.claim"
    for _ in range(2):
        p, fs = file_system(spark, mark)
        try:
            if fs.getUri().getScheme() == "file":  # Hadoop's local file system looks first and creates then
                fs.mkdirs(p.getParent())
                local = spark.sparkContext._jvm.java.nio.file
                none = spark.sparkContext._gateway.new_array(local.attribute.FileAttribute, 0)
                local.Files.createFile(local.Path.of(fs.makeQualified(p).toUri()), none)
            else:
                fs.create(p, False).close()
            return mark
        except Exception as e:
            if "already exists" not in str(e) and "AlreadyExists" not in str(e):
                raise
        try:
            age = time.time() - fs.getFileStatus(p).getModificationTime() / 1000
            aside, _ = file_system(spark, f"{mark}.{uuid.uuid4().hex}")
            if age < lease_seconds or not fs.rename(p, aside):
                return None
            fs.delete(aside, False)
        except Exception as e:  # given back in between
            if "FileNotFound" not in str(e):
                raise
    return None


def release(spark: SparkSession, mark: str) -> None:
    p, fs = file_system(spark, mark)
    fs.delete(p, False)


def _once(spark: SparkSession, target: str, mark_path: str, write, lease_seconds: float) -> bool:
    if table_exists(spark, target):
        return False
    mark = claim(spark, mark_path, lease_seconds)
    if mark is None:
        return False
    try:
        if table_exists(spark, target):  # written between the check and the claim
            return False
        write()
        return True
    finally:
        release(spark, mark)


def write_once(df: DataFrame, path: str, lease_seconds: float = LEASE_SECONDS) -> bool:
    """Load a table only if no committed copy is there yet; True when written.

    Of several loads at once one writes (see ``claim``). A folder without the job-commit
    marker is a load that died half-way (for example when executors were lost);
    it is overwritten, not trusted.
    """
    return _once(df.sparkSession, path, path, lambda: df.write.mode("overwrite").parquet(path), lease_seconds)


def load_table_once(df: DataFrame, table: str, location: str | None = None, lease_seconds: float = LEASE_SECONDS) -> bool:
    """As ``write_once`` for a table of the catalogue: managed, or kept at ``location``.

    A table counts as loaded once the catalogue has it; the claim stands in the shared checkpoint folder.
    """
    spark = df.sparkSession
    writer = df.write.format("parquet").mode("errorifexists")
    if location:
        writer = df.write.format("parquet").mode("overwrite").option("path", location)
    mark = location or scratch_path(spark, f"tallywise/claims/{table}")
    return _once(spark, table, mark, lambda: writer.saveAsTable(table), lease_seconds)


def replace_catalog_table(df: DataFrame, table: str, store: str) -> DataFrame:
    """Full replace of a table of the catalogue whose rows are kept as versions in ``store``.

    The new version is written whole; then the table's location is set to it, one
    entry of the catalogue. Queries that began before go on with the version before.
    """
    spark = df.sparkSession
    folder = replace_tables({"data": df}, store) + "/data"
    if table_exists(spark, table):
        same = [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]
        if same:
            spark.sql(f"alter table {table} set location '{folder}'")
            spark.catalog.refreshTable(table)
            return spark.table(table)
        spark.sql(f"drop table {table}")
    return spark.catalog.createTable(table, path=folder, source="parquet")


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """A catalog table, or a path holding a committed write: its marker or a version's pointer."""
    if "/" in name_or_path:
        path = name_or_path.rstrip("/")
        return path_exists(spark, f"{path}/_SUCCESS") or path_exists(spark, f"{path}/{POINTER}")
    return spark.catalog.tableExists(name_or_path)


def ranked(df: DataFrame, order, rank: str = "rank") -> DataFrame:
    """A report's rows with their place in its order (from 1), which a file set or table keeps.

    All columns follow the asked order as tie-breaks. Places are partition offsets plus
    positions, so no task sees the whole report."""
    by = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    return dense_index(df, [*by, *[F.col(f"`{c}`").asc_nulls_first() for c in df.columns]], rank)


def write_report(df: DataFrame, path: str, order=None, skip_empty: bool = False, fmt: str = "csv") -> bool:
    """Write a report (header CSV or parquet), globally sorted if asked.
    With ``skip_empty`` an empty result writes nothing. True when written.

    All columns follow the asked order as tie-breaks: reruns write the same order, and
    range partitioning can split rows that share the asked values."""
    if skip_empty and df.isEmpty():
        return False
    out = df.orderBy(*order, *[F.col(f"`{c}`") for c in df.columns]) if order else df
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.parquet(path)
    return True


def stamp(df: DataFrame, as_of: str, col: str = "import_date") -> DataFrame:
    """Attach the load time (one value per run, passed in, not read from a clock)."""
    return df.withColumn(col, F.lit(as_of))


def last_update_table(spark: SparkSession, as_of: str) -> DataFrame:
    return spark.createDataFrame([(as_of,)], "last_updated string")
