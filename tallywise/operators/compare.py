"""Full outer comparison join where null keys match each other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tallywise.operators.skew import HEAVY_ROWS, skew_join


def null_safe_full_outer(left: DataFrame, right: DataFrame, left_keys, right_keys,
                         skew_safe: bool = True, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Full outer join on ``left_keys[i] <=> right_keys[i]`` for all i.

    Key expressions are Columns bound to each side; the two sides must have
    disjoint column names. With ``skew_safe`` (default) a key with very many
    rows, whole or null (all lines without an order number, say), is dealt
    into slices (see ``skew_join``): a sort-merge full outer join cannot be split
    by AQE when one key is hot.
    """
    if skew_safe:
        return skew_join(left, right, left_keys, right_keys, "full_outer", null_safe=True, heavy_rows=heavy_rows)
    return left.join(right, reduce(lambda x, y: x & y, [a.eqNullSafe(b) for a, b in zip(left_keys, right_keys)]), "full_outer")
