"""``EXISTS (other row with same key and a different value)`` without a
residual-condition join.

Per key, the picking side is reduced to the smallest and largest value (an
aggregate with a map-side step). A row qualifies exactly when its value is
not null and differs from the min or the max, i.e. when the other side holds
at least one non-null value other than its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exists_other_value(rows: DataFrame, row_key: str, row_value: str,
                       other: DataFrame, other_key: str, other_value: str) -> DataFrame:
    """Rows of ``rows`` for which ``other`` has a row with the same key and a
    different (non-null) value. Same as the semi join
    ``rows.key = other.key AND rows.value <> other.value``."""
    span = (other.filter(F.col(other_key).isNotNull())
            .groupBy(F.col(other_key).alias("__k"))
            .agg(F.min(other_value).alias("__lo"), F.max(other_value).alias("__hi")))
    cond = ((rows[row_key] == span["__k"])
            & rows[row_value].isNotNull()
            & ((span["__lo"] != rows[row_value]) | (span["__hi"] != rows[row_value])))
    return rows.join(span, cond, "left_semi")
