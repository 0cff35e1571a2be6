"""Landing-file readers: CSV exports, JSON lines, newest file in a folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def file_position() -> Column:
    """Where a row of a file source stands, as a value that sorts in file order:
    (folder, part number, file path, start of the split, position in the split).

    Rows of one split arrive in file order and the generated id grows within
    a task, so this is a total order over all files without reading
    any two files in one task. Part files of one export are ordered by their number.
    """
    file = F.col("_metadata.file_path")
    return F.struct(F.regexp_replace(file, "[^/]*$", "").alias("folder"),
                    F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(file, r"part-(\d{1,18})[^/]*$", 1), F.lit("")),
                                               F.lit("9" * 18)).cast("bigint"), F.lit(-1)).alias("part"),
                    file.alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("pos"))


def read_csv(spark: SparkSession, path: str, schema, encoding: str = "UTF-8", position: str | None = None) -> DataFrame:
    """CSV export read by its header: columns are taken by name, whatever their
    order, and cast to the declared schema; absent ones are null, further ones
    are left out. Doubled quotes and quoted line breaks are understood, which takes a
    whole file per task: land a large export as many files. A malformed
    row or number fails the read. ``position`` names a further column that sorts in
    file order (see ``file_position``)."""
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = (spark.read.option("header", True).option("encoding", encoding).option("multiLine", True)
           .option("escape", '"').option("mode", "FAILFAST").csv(path))
    columns = [(F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name)
               for f in wanted.fields]
    return raw.select(*columns, *([file_position().alias(position)] if position else []))


def write_csv(df: DataFrame, path: str) -> None:
    """A header CSV that ``read_csv`` understands."""
    df.write.option("header", True).option("escape", '"').csv(path)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as text ``(value, line_no)``; ``line_no`` sorts in file order (``file_position``)."""
    return spark.read.text(path).select("value", file_position().alias("line_no"))


def newest_file(spark: SparkSession, pattern: str) -> str | None:
    """Path of the most recently modified file matching ``pattern`` (of equal times the
    greatest path), as an aggregate over the files' metadata; no content is read."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime")
    return files.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = file_system(spark, path)
    return bool(fs.exists(p))


#: What a source that is not there, or lacks the wanted columns, raises.
ABSENT = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"}


def first_usable(*readers):
    """Return the first reader result that is usable (a DataFrame with rows
    and the wanted columns); readers are tried in order. Only a missing table or
    path, or missing columns, falls through to the next; any other error is raised."""
    for read in readers:
        try:
            df = read()
            if df is not None and not df.isEmpty():
                return df
        except AnalysisException as e:
            kind = e.getCondition() or ""
            if kind not in ABSENT and not kind.startswith("UNRESOLVED_COLUMN"):
                raise
    return None
