"""Tables replaced in one step: versioned folders behind a pointer.

    <store>/v-<time>-<id>/<table>/part-...     one folder per commit
    <store>/_CURRENT                           the name of the folder that counts

A load writes a whole new version beside the old one. Readers go on with the
old until the pointer is switched by one atomic rename over the old pointer;
all tables of the commit switch together. A load that dies half-way leaves a
folder that no pointer names. The version before the current one is kept for
readers that resolved it already; older ones go when a commit has succeeded.
Where two loads run at once, the last switch wins, whole.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from tallywise.sources.files import file_system

POINTER = "_CURRENT"


def _read_text(spark: SparkSession, path: str) -> str | None:
    p, fs = file_system(spark, path)
    jvm = spark.sparkContext._jvm
    try:
        stream = fs.open(p)
    except Exception as e:  # the pointer is not there: no version yet
        if "FileNotFoundException" in str(e):
            return None
        raise
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _switch(spark: SparkSession, store: str, version: str) -> None:
    """Point the store to ``version``: written aside, then renamed over the pointer."""
    jvm = spark.sparkContext._jvm
    aside, fs = file_system(spark, f"{store}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(version.encode()))
    out.close()
    final, _ = file_system(spark, f"{store}/{POINTER}")
    option = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    option[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(aside), fs.makeQualified(final), option)


def current_version(spark: SparkSession, store: str) -> str | None:
    """Folder of the version that counts, or None before the first commit."""
    name = _read_text(spark, f"{store.rstrip('/')}/{POINTER}")
    return f"{store.rstrip('/')}/{name}" if name else None


def replace_tables(tables: dict[str, DataFrame], store: str, keep: int = 1) -> str:
    """Write all ``tables`` as one new version, then switch to it. Returns its folder.

    ``keep``: how many versions before the new one stay.
    """
    store = store.rstrip("/")
    spark = next(iter(tables.values())).sparkSession
    before = current_version(spark, store)
    name = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    for table, df in tables.items():
        df.write.parquet(f"{store}/{name}/{table}")
    _switch(spark, store, name)
    _drop_older(spark, store, name, before, keep)
    return f"{store}/{name}"


def _drop_older(spark: SparkSession, store: str, name: str, before: str | None, keep: int) -> None:
    """Remove versions older than the last ``keep`` that counted; unfinished ones of the same age go with them."""
    root, fs = file_system(spark, store)
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("v-"))
    older = [n for n in names if n < (min(before.rsplit("/", 1)[1], name) if before else name)]
    for n in older[:len(older) - (keep - 1)] if keep > 1 else older:
        fs.delete(file_system(spark, f"{store}/{n}")[0], True)


def read_table(spark: SparkSession, store: str, table: str = "data") -> DataFrame:
    """The current version of a table. A plain Parquet folder is read as it is."""
    folder = current_version(spark, store)
    return spark.read.parquet(f"{folder}/{table}" if folder else store)
