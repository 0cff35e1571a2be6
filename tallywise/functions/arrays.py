"""Array helpers for nested order documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywise.functions.text import col_

__all__ = ["join_field", "nth_field", "sum_field", "sum_nested_where", "array_text"]


def join_field(arr, field: str, sep: str = ", ") -> Column:
    """Join one text field of an array of structs; missing field counts as ''."""
    a = col_(arr)
    return F.when(F.coalesce(F.size(a), F.lit(0)) > 0,
                  F.array_join(F.transform(a, lambda x: F.coalesce(x.getField(field), F.lit(""))), sep)
                  ).otherwise(F.lit(""))


def nth_field(arr, i: int, field: str) -> Column:
    """Field of the i-th element (0-based); null if the array is short."""
    return F.try_element_at(col_(arr), F.lit(i + 1)).getField(field)


def sum_field(arr, field: str) -> Column:
    """Sum of a numeric field over an array; 0.0 when null or empty."""
    total = F.aggregate(col_(arr), F.lit(0.0),
                        lambda acc, x: acc + F.coalesce(x.getField(field).cast("double"), F.lit(0.0)))
    return F.coalesce(total, F.lit(0.0))


def sum_nested_where(arr, inner: str, field: str, kind_field: str, kind: str,
                     kind_level: str = "inner") -> Column:
    """Sum ``field`` over ``arr[].inner[]`` keeping items whose kind matches.

    ``kind_level='inner'`` tests the kind on the inner item, ``'outer'`` on
    the outer element.
    """
    def amount(t):
        return F.coalesce(t.getField(field).cast("double"), F.lit(0.0))

    def per_outer(o):
        if kind_level == "outer":
            keep = F.coalesce(o.getField(kind_field) == F.lit(kind), F.lit(False))
            inner_sum = F.aggregate(o.getField(inner), F.lit(0.0), lambda a2, t: a2 + amount(t))
            return F.when(keep, F.coalesce(inner_sum, F.lit(0.0))).otherwise(F.lit(0.0))
        inner_sum = F.aggregate(
            o.getField(inner), F.lit(0.0),
            lambda a2, t: a2 + F.when(F.coalesce(t.getField(kind_field) == F.lit(kind), F.lit(False)),
                                      amount(t)).otherwise(F.lit(0.0)))
        return F.coalesce(inner_sum, F.lit(0.0))

    total = F.aggregate(col_(arr), F.lit(0.0), lambda acc, o: acc + per_outer(o))
    return F.coalesce(total, F.lit(0.0))


def array_text(arr) -> Column:
    """Array printed as JSON text (``[]`` for an empty or missing array)."""
    return F.coalesce(F.to_json(col_(arr)), F.lit("[]"))
