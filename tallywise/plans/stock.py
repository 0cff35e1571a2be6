"""Stock cross-reference: ERP quants vs storefront products and inventory.

Inputs (canonical columns)
  quants          product (the ERP's pair: struct<id, label>), location_label, quantity,
                  available_quantity, tracking, category
  sizes           name, container_capacity
  products        sku, title, option1, inventory_quantity, old_inventory_quantity, status
  inventory       sku, title, option_value, on_hand, available, committed, unavailable, incoming
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.functions import bracket_code, like_pattern, pair_label, sku_prefix, sku_suffix
from tallywise.operators import HEAVY_ROWS, broadcast_if_small, by_shuffle, prefix_equi_join, skew_join

from tallywise.sources.files import first_usable

from tallywise.constants import (
    ACTIVE_STATUS, MISMATCH_THRESHOLD, SIZE_BAND, SIZE_MISMATCH_NOTE, STOCK_CATEGORY, STOCK_LOCATION_PATTERN,
    STOCK_TRACKING,
)


def clean_odoo_stock(quants: DataFrame, location_pattern: str = STOCK_LOCATION_PATTERN,
                     tracking: str | None = STOCK_TRACKING, category: str | None = STOCK_CATEGORY,
                     case_blind: bool = True) -> DataFrame:
    """Domain filter on the raw columns (so it reaches the scan), then the
    pair labels and the SKU parts derived from the product label."""
    cond = like_pattern("location_label", location_pattern, case_blind=case_blind)
    if tracking is not None:
        cond = cond & (F.col("tracking") == F.lit(tracking))
    if category is not None:
        cond = cond & (F.col("category") == F.lit(category))
    label = pair_label("product")
    code = bracket_code(label)
    return quants.filter(cond).select(
        label.alias("product_id"),
        F.col("location_label").alias("location_id"),
        "quantity", "available_quantity",
        code.alias("default_code"),
        sku_prefix(code).alias("plant_prefix"),
        sku_suffix(code).alias("size_suffix"),
    )


def sku_parts(quants: DataFrame) -> DataFrame:
    code = bracket_code("product_label")
    return quants.select("product_label", code.alias("default_code"),
                         sku_prefix(code).alias("plant_prefix"), sku_suffix(code).alias("size_suffix"))


SIZE_SCHEMA = "name string, container_capacity double"


def size_dimension(*readers) -> DataFrame:
    """The size dimension from the first usable source: the ERP's table, else the shared CSV copy, else the
    table of an earlier run (each a function that reads it). A source that is missing, empty or lacks a column
    is passed over; any other error is raised. Without any the capacities stay empty."""
    found = first_usable(*[lambda read=read: read().select("name", "container_capacity") for read in readers])
    return found if found is not None else SparkSession.active().createDataFrame([], SIZE_SCHEMA)


def total_by_location(stock: DataFrame, sizes: DataFrame) -> DataFrame:
    """Quantities per product, location and size, with container capacity.

    The size dimension is tiny and joined by broadcast before the aggregate,
    so the only shuffle is the (map-side combined) group-by.
    """
    sz = broadcast_if_small(sizes.select("name", "container_capacity"))
    j = stock.join(sz, stock["size_suffix"] == sz["name"], "left")
    return j.groupBy("product_id", "location_id", "default_code", "plant_prefix", "size_suffix",
                     "container_capacity").agg(
        F.sum("quantity").alias("odoo_qty"), F.sum("available_quantity").alias("odoo_available_qty"))


def location_counts(totals: DataFrame) -> DataFrame:
    return (totals.filter(F.col("odoo_qty") != 0).groupBy("product_id")
            .agg(F.count(F.lit(1)).alias("loc_count")))


def loc_count_order():
    return [F.col("loc_count").desc()]


def combined_storefront(products: DataFrame, inventory: DataFrame) -> DataFrame:
    """Per product SKU: inventory figures, falling back to product figures.

    Same result as ``products LEFT JOIN inventory ON sku`` followed by
    ``max(coalesce(inventory value, product value, 0))`` per SKU, but both
    sides are aggregated per SKU first (map-side combined), so a SKU with
    many rows never meets the other side row by row, and the join is 1:1.
    For each figure the maximum over the joined pairs is the larger of the
    inventory maximum and, when some inventory row lacks the value (or there
    is no inventory row), the product fallback maximum.
    """
    sp = products.groupBy("sku").agg(
        F.max("title").alias("title"), F.max("status").alias("status"),
        F.max(F.coalesce(F.col("old_inventory_quantity"), F.lit(0.0))).alias("__sp_on_hand"),
        F.max(F.coalesce(F.col("inventory_quantity"), F.lit(0.0))).alias("__sp_available"))
    figures = ["on_hand", "available", "committed", "unavailable"]
    si = inventory.filter(F.col("sku").isNotNull()).groupBy(F.col("sku").alias("__si_sku")).agg(
        *[F.max(c).alias(f"__si_{c}") for c in figures],
        *[F.max(F.col(c).isNull().cast("int")).alias(f"__si_{c}_gap") for c in figures])
    j = sp.join(by_shuffle(si), sp["sku"] == si["__si_sku"], "left")
    no_inv = F.col("__si_sku").isNull()

    def figure(c: str, fallback):
        gap = no_inv | (F.col(f"__si_{c}_gap") == 1)
        return F.greatest(F.col(f"__si_{c}"), F.when(gap, fallback)).alias(c)

    return j.select(
        "sku", "title", "status",
        figure("on_hand", F.col("__sp_on_hand")), figure("available", F.col("__sp_available")),
        figure("committed", F.lit(0.0)), figure("unavailable", F.lit(0.0)))


def size_mismatches(stock: DataFrame, products: DataFrame, band: float = SIZE_BAND) -> DataFrame:
    """ERP stock held under one size while the storefront shows stock for a
    sibling size of the same plant with a quantity within ``band``.

    ``sibling.sku LIKE prefix || '-%'`` (case-blind) runs as an equi-join on
    exploded hyphen prefixes plus a quantity bucket (band width ``band``), so
    only rows with near quantities are paired; inequality and the exact band
    remain residual filters.
    """
    o = stock.filter((F.col("quantity") > 0) & (F.col("plant_prefix") != ""))
    own = products.select(F.col("sku").alias("__own_sku"), F.col("inventory_quantity").alias("__own_q"))
    o = (o.join(by_shuffle(own), o["default_code"] == own["__own_sku"], "left")
         .filter((F.col("__own_q") == 0) | F.col("__own_q").isNull())
         .select("default_code", "size_suffix", "quantity", "plant_prefix"))
    s2 = products.filter(F.col("inventory_quantity") > 0).select(
        F.col("sku").alias("correct_shopify_sku"), F.col("option1").alias("correct_size"),
        F.col("inventory_quantity").alias("shopify_qty"))
    # Band join: a stock row sits in bucket floor(q / band); a storefront row
    # can only be within the band of rows in its own or a neighbouring bucket.
    if band > 0:
        bucket = lambda q: F.floor(q / F.lit(band)).cast("bigint")
        near = F.array(*[bucket(F.col("shopify_qty")) + d for d in (-1, 0, 1)])
        j = prefix_equi_join(s2, "correct_shopify_sku", o, "plant_prefix",
                             text_keys=near, prefix_key=bucket(F.col("quantity")))
    else:
        j = prefix_equi_join(s2, "correct_shopify_sku", o, "plant_prefix")
    j = j.filter((F.col("correct_shopify_sku") != F.col("default_code"))
                 & (F.abs(F.col("quantity") - F.col("shopify_qty")) <= F.lit(band)))
    note = F.concat(F.lit(SIZE_MISMATCH_NOTE[0]), F.col("size_suffix"), F.lit(SIZE_MISMATCH_NOTE[1]),
                    F.col("correct_size"), F.lit(SIZE_MISMATCH_NOTE[2]))
    return j.select(
        F.col("default_code").alias("odoo_sku"), F.col("size_suffix").alias("odoo_size"),
        F.col("quantity").alias("odoo_qty"), "correct_shopify_sku", "correct_size", "shopify_qty",
        note.alias("mismatch_note")).distinct()


def stock_cross_reference(totals: DataFrame, combined: DataFrame, loc_count: DataFrame,
                          mismatches: DataFrame) -> DataFrame:
    """Per product and location: ERP totals vs storefront figures, location
    count and any size-mismatch suggestion (these fan out)."""
    held = totals.filter(F.col("odoo_qty") != 0).select("product_id", "location_id", "default_code",
                                                        F.col("odoo_qty").alias("odoo_onhand_qty"), "odoo_available_qty")
    offered = combined.select(F.col("sku").alias("default_code"), "title", "status",
                              *[F.col(c).alias(f"shopify_{out}_qty") for c, out in (
                                  ("on_hand", "onhand"), ("available", "available"), ("committed", "committed"),
                                  ("unavailable", "unavailable"))])
    hints = mismatches.select(F.col("odoo_sku").alias("default_code"), F.col("correct_shopify_sku").alias("potential_correct_sku"),
                              F.col("correct_size").alias("potential_correct_size"), F.col("mismatch_note").alias("size_mismatch_note"))
    joined = (held.join(offered, "default_code", "left").filter((F.col("status") == ACTIVE_STATUS) | F.col("status").isNull())
              .join(hints, "default_code", "left").join(loc_count, "product_id", "left"))
    return joined.select(
        "product_id", "location_id", "loc_count", "odoo_onhand_qty", "odoo_available_qty",
        "shopify_onhand_qty", "shopify_available_qty", "shopify_committed_qty", "shopify_unavailable_qty",
        (F.col("odoo_onhand_qty") - F.col("shopify_onhand_qty")).alias("diff_onhand"),
        (F.col("odoo_available_qty") - F.col("shopify_available_qty")).alias("diff_available"),
        "title", "status", "potential_correct_sku", "potential_correct_size", "size_mismatch_note")


def xref_order():
    """Report sort: noted mismatches first, location, then the two differences descending."""
    return [
        F.when(F.col("size_mismatch_note").isNotNull(), 0).otherwise(1),
        F.col("location_id"),
        F.when(F.col("shopify_onhand_qty") != 0, F.abs(F.col("odoo_onhand_qty") - F.col("shopify_onhand_qty")))
         .otherwise(F.col("odoo_onhand_qty")).desc(),
        F.when(F.col("shopify_available_qty") != 0,
               F.abs(F.col("odoo_available_qty") - F.col("shopify_available_qty")))
         .otherwise(F.col("odoo_available_qty")).desc(),
    ]


def cross_reference_extended(stock: DataFrame, inventory: DataFrame) -> DataFrame:
    """Every quant with the storefront inventory of its SKU, where either
    side holds stock. Sorting is left to the report writer."""
    shop = inventory.select(F.col("sku").alias("shopify_sku"), F.col("title").alias("shopify_title"),
                            F.col("option_value").alias("shopify_option"),
                            *[F.col(c).alias(f"shopify_{c}") for c in ("on_hand", "available", "committed", "unavailable", "incoming")])
    joined = (stock.join(by_shuffle(shop), stock["default_code"] == shop["shopify_sku"], "left")
              .filter((F.col("quantity") > 0) | (F.col("shopify_on_hand") > 0)))
    return joined.select(
        "product_id", "location_id", F.col("default_code").alias("odoo_sku"), F.col("quantity").alias("odoo_quantity"),
        F.col("quantity").alias("odoo_available"), *shop.columns,
        (F.col("quantity") - F.coalesce("shopify_on_hand", F.lit(0.0))).alias("quantity_diff"),
        (F.col("quantity") - F.coalesce("shopify_available", F.lit(0.0))).alias("available_diff"),
    )


def extended_order():
    return [F.when(F.col("shopify_on_hand").isNotNull(),
                   F.abs(F.col("odoo_quantity") - F.col("shopify_on_hand")))
            .otherwise(F.col("odoo_quantity")).desc()]


def mismatch_order():
    """The mismatch report's sort: largest difference first."""
    return [F.abs(F.col("shopify_on_hand") - F.col("odoo_quantity")).desc()]


def significant_mismatches(extended: DataFrame, threshold: float = MISMATCH_THRESHOLD) -> DataFrame:
    return extended.filter(F.col("shopify_sku").isNotNull() & (F.col("odoo_quantity") > 0)
                           & (F.col("shopify_on_hand") != F.col("odoo_quantity"))
                           & (F.abs(F.col("shopify_on_hand") - F.col("odoo_quantity")) > threshold))


def sku_size_swaps(stock: DataFrame, inventory: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Same plant, two sizes: the ERP holds one size the storefront shows as
    empty, while the storefront holds the other size the ERP shows as empty.

    Each side is filtered and joined to its inventory row first; only the
    reduced sides meet in the prefix self-join.
    """
    inv = inventory.select("sku", "on_hand", "option_value", "title")

    def side(rows: DataFrame, offered: DataFrame, n: int) -> DataFrame:
        """Stock rows with the inventory row of their SKU, columns numbered."""
        both = rows.join(by_shuffle(offered), rows["default_code"] == offered["sku"])
        return both.select(F.col("plant_prefix").alias(f"__p{n}"), F.col("default_code").alias(f"odoo_sku{n}"),
                           F.col("quantity").alias(f"odoo_qty{n}"), F.col("size_suffix").alias(f"odoo_size{n}"),
                           F.col("sku").alias(f"shopify_sku{n}"), F.col("on_hand").alias(f"shopify_qty{n}"),
                           F.col("option_value").alias(f"shopify_size{n}"), F.col("title").alias(f"title{n}"))

    l2 = side(stock.filter(F.col("quantity") > 0), inv.filter(F.col("on_hand") == 0), 1)
    r2 = side(stock.filter(F.col("quantity") == 0), inv.filter(F.col("on_hand") > 0), 2)
    # A plant that holds much of the stock is dealt into slices on both sides.
    j = (skew_join(l2, r2, ["__p1"], ["__p2"], heavy_rows=heavy_rows)
         .filter(F.col("odoo_size1") != F.col("odoo_size2")))
    return j.select("odoo_sku1", "odoo_qty1", "odoo_size1", "odoo_sku2", "odoo_qty2", "odoo_size2",
                    "shopify_sku1", "shopify_qty1", "shopify_size1", "shopify_sku2", "shopify_qty2",
                    "shopify_size2", F.col("title1").alias("title"))
