"""Column-set handling: reindex, rename-and-require, intersect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reindex(df: DataFrame, columns, default_type: str = "string") -> DataFrame:
    """Select ``columns`` in order; absent ones become typed nulls."""
    present = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in present else F.lit(None).cast(default_type).alias(c)
                       for c in columns])


def rename_require(df: DataFrame, mapping: dict, required) -> DataFrame:
    """Rename by a map (absent names ignored), then require columns."""
    out = df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})
    missing = [c for c in required if c not in out.columns]
    if missing:
        raise ValueError(f"missing required columns after rename: {missing}")
    return out


def keep_available(df: DataFrame, wanted) -> DataFrame:
    """Project the wanted columns that the source actually offers."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in have])


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once (with their count): a check for
    dimensions whose duplicates would fan out joins or double sums."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
