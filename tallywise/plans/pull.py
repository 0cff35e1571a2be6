"""Warehouse pull sheet from a transfer (picking) sheet and ERP stock.

Inputs (canonical columns)
  picking   order_text, item, location, quantity, on_hand  (after rename_picking)
  quants    product (the ERP's pair: struct<id, label>), location_label, quantity
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.functions import (
    like_pattern, order_before_slash, pair_label, strip_brackets, strip_text, to_number_or_zero,
)
from tallywise.operators import exists_other_value, rename_require
from tallywise.sources.files import read_csv

from tallywise.constants import PICKING_RENAME, PULL_LOCATION_PATTERN, STOCK_PREFIX

PICKING_REQUIRED = list(PICKING_RENAME.values())


def rename_picking(raw: DataFrame) -> DataFrame:
    """Map the export's headers to the canonical names and require them."""
    return rename_require(raw, PICKING_RENAME, PICKING_REQUIRED)


def read_picking(spark: SparkSession, path: str) -> DataFrame:
    """A transfer sheet landed as a header CSV; a sheet that lacks one of the columns is refused."""
    header = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).columns
    kinds = {"quantity": "double", "on_hand": "double"}
    schema = ", ".join(f"`{h}` {kinds.get(c, 'string')}" for h, c in PICKING_RENAME.items() if h in header)
    return rename_picking(read_csv(spark, path, schema))


def pullsheet(picking: DataFrame) -> DataFrame:
    """Lines to pick (positive quantity) with order number, clean item name
    and short location. Sorting (location, item, order) is done by the writer."""
    return picking.filter(F.col("quantity") > 0).select(
        order_before_slash("order_text").alias("ord"),
        strip_brackets(F.col("item").cast("string")).alias("item"),
        strip_text(F.col("location").cast("string"), STOCK_PREFIX).alias("location"),
        F.col("quantity").alias("qty"),
        F.col("on_hand"),
    )


PULLSHEET_ORDER = ["location", "item", "ord"]
TARGETS_ORDER = ["ord"]
ALT_STOCK_ORDER = ["product_id", "location_id"]


def order_targets(picking: DataFrame) -> DataFrame:
    """Per order: number of lines to pick and total plants, in one aggregate
    (the two per-order aggregates and their join collapse into one pass)."""
    return (picking.filter(F.col("quantity") > 0)
            .groupBy(order_before_slash("order_text").alias("ord"))
            .agg(F.count(F.lit(1)).alias("skus"), F.sum("quantity").alias("plants")))


def stock_levels(quants: DataFrame, location_pattern: str = PULL_LOCATION_PATTERN) -> DataFrame:
    """ERP stock for the pull sheet: case-sensitive location test only."""
    return quants.filter(like_pattern("location_label", location_pattern)).select(
        pair_label("product").alias("product_id"),
        F.col("location_label").cast("string").alias("location_id"),
        to_number_or_zero("quantity").alias("quantity"))


def alternative_stock(levels: DataFrame, picking: DataFrame) -> DataFrame:
    """Stock of items being picked held at other locations than a pick
    location, distinct. The inequality semi join runs as an equi-join to a
    per-item (min, max) location summary."""
    # DISTINCT first (map-side combined); the semi join keeps or drops whole
    # rows, so its output stays distinct and its skew can be split by AQE.
    distinct_levels = levels.select("product_id", "location_id", "quantity").distinct()
    return exists_other_value(distinct_levels, "product_id", "location_id", picking, "item", "location")
