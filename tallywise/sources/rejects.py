"""Documents that cannot be parsed: fail the load, or keep them apart.

A document counts as broken if its text is no JSON of the declared schema: cut
off, not an object, or with a value of another kind (which a lenient parse would
turn into nulls). Blank lines are no documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.sources.files import read_json_lines

_BROKEN = "__broken"


@dataclass
class Documents:
    """``rows``: the parsed documents with their ``line_no``; ``rejects``: file, line_no, value of the others."""
    rows: DataFrame
    rejects: DataFrame


def split_documents(text: DataFrame, schema: T.StructType, value: str = "value", position: str = "line_no") -> Documents:
    """Part the documents of a text column. Both frames read ``text``; stage it where reading is dear."""
    kinds = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    parsed = text.filter(F.trim(value) != "").select(
        position, F.col(value).alias("value"),
        F.from_json(value, kinds, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}).alias("d"))
    broken = F.col("d").isNull() | F.col(f"d.{_BROKEN}").isNotNull()
    rejects = parsed.filter(broken).select(
        *([F.col(f"{position}.file").alias("file")] if isinstance(text.schema[position].dataType, T.StructType) else []),
        F.col(position), "value")
    return Documents(parsed.filter(~broken).select(*[F.col(f"d.`{f.name}`") for f in schema.fields], position), rejects)


def read_documents(spark: SparkSession, path: str, schema: T.StructType, keep_broken: bool = False) -> Documents:
    """Landed JSON lines. By default a broken document fails whatever reads ``rows``, naming its file."""
    lines = read_json_lines(spark, path)
    found = split_documents(lines, schema)
    if keep_broken:
        return found
    kinds = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    d = F.from_json("value", kinds, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    parsed = lines.select("line_no", "value", d.alias("d"))
    said = F.raise_error(F.concat(F.lit("not a document: "), F.col("line_no.file"), F.lit(": "), F.substring("value", 1, 200)))
    # one expression: the order in which filters are tried is not fixed
    sound = F.when(F.trim("value") == "", F.lit(False)).when(F.col("d").isNull() | F.col(f"d.{_BROKEN}").isNotNull(), said.cast("boolean")).otherwise(F.lit(True))
    return Documents(parsed.filter(sound).select(*[F.col(f"d.`{f.name}`") for f in schema.fields], "line_no"), found.rejects.limit(0))
