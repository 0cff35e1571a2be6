"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
import weakref
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.session import scratch_path

_ARROW = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(),
          T.BooleanType(): pa.bool_(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, prefixed until no column of ``df`` has it (any letter case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    return _ARROW[kind]


#: Folders written by the pipeline stage that is being built.
_OWN: list[str] | None = None
#: Results of stages and the folders that they read.
_HELD: list[tuple[weakref.ref, list[str]]] = []


def pipeline_stage(fn):
    """A stage of the pipeline. What it stages belongs to the DataFrame that it returns: a folder goes when
    a later stage begins and that DataFrame is no longer held. Keep it as long as frames derived from it are read."""
    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        global _OWN, _HELD
        for held, paths in _HELD:
            if held() is None:
                for path in paths:
                    drop_folder(spark, path)
        _HELD = [x for x in _HELD if x[0]() is not None]
        _OWN = own = []
        try:
            made = fn(spark, docs, sf_dir)
        finally:
            _OWN = None
        _HELD.append((weakref.ref(made), own))
        return made
    return run


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage (a lost executor costs no recomputation of what is
    written) and lets later steps prune columns. The folder is named by the
    session's ``spark.checkpoint.dir``; every call takes a new sub-folder.
    """
    path = scratch_path(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
    write_texts(df, path)
    if _OWN is not None:
        _OWN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``stage``, with the folder, which the caller gives to ``drop_folder``
    once nothing reads it any more."""
    path = scratch_path(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
    write_texts(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def write_texts(df: DataFrame, path: str) -> None:
    """Write as Parquet in row groups of 16 MB, which a task holds in memory."""
    df.write.option("parquet.block.size", 16 << 20).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: Bytes of texts that a Python function sees at once.
TEXT_BYTES = 4 << 20


def byte_runs(texts: pa.Array, most: int = TEXT_BYTES):
    """(start, length) of runs of texts with about ``most`` bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, before = 0, 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, stop - at
        at, before = stop, int(ends[stop - 1])


def release_memory() -> None:
    """Give freed memory back to the system: workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def with_arrow_columns(df: DataFrame, text: str, fields: list[tuple[str, T.DataType]], fn) -> DataFrame:
    """Append columns computed from one text column, ``TEXT_BYTES`` of an Arrow batch at a time.

    ``fn`` takes texts as an Arrow array (null: empty) and returns
    a list or Arrow array per field. All columns of ``df`` pass through unchanged.
    """
    at = df.columns.index(text)
    names = df.columns + [n for n, _ in fields]
    kinds = [arrow_type(k) for _, k in fields]
    schema = T.StructType(df.schema.fields + [T.StructField(n, k, True) for n, k in fields])

    def run(batches):
        try:
            for batch in batches:
                for start, n in byte_runs(batch.column(at)):
                    part = batch.slice(start, n)
                    made = fn(part.column(at).fill_null(""))
                    yield pa.RecordBatch.from_arrays(
                        part.columns + [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(made, kinds)], names)
        finally:
            release_memory()

    return df.mapInArrow(run, schema)


def with_text_columns(df: DataFrame, text: str, fields: list[tuple[str, T.DataType]], fn) -> DataFrame:
    """As ``with_arrow_columns``, with the texts as a list."""
    return with_arrow_columns(df, text, fields, lambda texts: fn(texts.to_pylist()))


def hex16(col):
    """A long's 64 bits as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))
