"""Query keys: one Spark plan and (where SQL can say it) one oracle SQL each.

Every query reads the driver's tables through the fixture views, so its work
grows with the tables. Oracle texts inline the same fixture views as CTEs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle.strip()
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from tallywise.plans import q_orders, q_stock, q_pull, q_imports, q_inventory, q_flatten, q_io  # noqa: F401
