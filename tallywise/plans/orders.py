"""Order flow: storefront lines vs ERP lines.

Library functions take landing DataFrames with these canonical columns:

storefront lines  order_name, sku, product_name, quantity, price, financial_status, fulfillment_status,
                  created_at, paid_at, fulfilled_at, total, email, tags, billing_name (numbers as text)
ERP lines         order_ref (storefront reference), erp_name, odoo_id, sku, product_name, quantity, price,
                  payment_status, delivery_status, order_date, total (numbers as text)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywise.functions import (
    date_parts, iso_utc, null_concat, order_number, parse_offset_ts, plant_name, same_or_both_null, to_number, within,
)
from tallywise.operators import broadcast_if_small, null_safe_full_outer

from tallywise.constants import LEGACY_SKU_SUFFIX, PAID_STATUS, PRICE_TOLERANCE, SYNC_ACTIONS, SYNC_STATUSES


# Columns of the comparison on either side, and the landing columns they come from.
STOREFRONT_COLUMNS = {
    "shopify_order_number": "order_name", "shopify_sku": "sku", "shopify_product_name": "product_name",
    "shopify_quantity": "quantity", "shopify_price": "price", "shopify_financial_status": "financial_status",
    "shopify_fulfillment_status": "fulfillment_status", "shopify_created_at": "created_at",
    "shopify_paid_at": "paid_at", "shopify_fulfilled_at": "fulfilled_at", "shopify_total": "total",
}
ERP_COLUMNS = {
    "odoo_shopify_order_number": "order_ref", "odoo_sku": "sku", "odoo_product_name": "product_name",
    "odoo_quantity": "quantity", "odoo_price": "price", "odoo_payment_status": "payment_status",
    "odoo_delivery_status": "delivery_status", "odoo_order_date": "order_date", "odoo_total": "total",
    "odoo_order_name": "erp_name", "odoo_order_id": "odoo_id",
}
_NUMBERS = ("quantity", "price")


def _side(lines: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One side's columns under their names in the comparison; numbers coerced (bad text -> null)."""
    return lines.select(*[(to_number(c) if c in _NUMBERS else F.col(c)).alias(name) for name, c in columns.items()])


def storefront_side(lines: DataFrame) -> DataFrame:
    return _side(lines, STOREFRONT_COLUMNS)


def erp_side(lines: DataFrame) -> DataFrame:
    return _side(lines, ERP_COLUMNS)


def compare_orders(storefront: DataFrame, erp: DataFrame, as_of: str | None = None) -> DataFrame:
    """Line-by-line comparison with a five-way sync status, and the time ``as_of`` as ``comparison_date`` if given.

    Full outer join on lower-cased (order, SKU) where null matches null; a
    row is 'in' a side when that side's order number is present. The join is
    the skew-safe form of ``null_safe_full_outer``.
    """
    s = storefront_side(storefront)
    e = erp_side(erp)
    joined = null_safe_full_outer(
        s, e,
        [F.lower(s["shopify_order_number"]), F.lower(s["shopify_sku"])],
        [F.lower(e["odoo_shopify_order_number"]), F.lower(e["odoo_sku"])],
    )
    in_s = F.col("shopify_order_number").isNotNull()
    in_o = F.col("odoo_shopify_order_number").isNotNull()
    qty_ok = same_or_both_null("shopify_quantity", "odoo_quantity")
    price_ok = (within("shopify_price", "odoo_price", PRICE_TOLERANCE)
                | (F.col("shopify_price").isNull() & F.col("odoo_price").isNull()))
    status = (F.when(~in_s, F.lit(SYNC_STATUSES[0]))
              .when(~in_o, F.lit(SYNC_STATUSES[1]))
              .when(~qty_ok, F.lit(SYNC_STATUSES[2]))
              .when(~price_ok, F.lit(SYNC_STATUSES[3]))
              .otherwise(F.lit(SYNC_STATUSES[4])))
    return joined.select(
        *STOREFRONT_COLUMNS, *ERP_COLUMNS,
        in_s.alias("in_shopify"), in_o.alias("in_odoo"), qty_ok.alias("quantity_match"),
        price_ok.alias("price_match"), status.alias("sync_status"),
        *([F.lit(as_of).alias("comparison_date")] if as_of is not None else []),
    )


def sync_status_counts(comparison: DataFrame) -> DataFrame:
    return comparison.groupBy("sync_status").agg(F.count(F.lit(1)).alias("n_lines"))


ACTIONS = SYNC_ACTIONS


def sync_actions(comparison: DataFrame) -> DataFrame:
    """Rows that need work in the ERP, tagged import (missing) or update."""
    action = F.when(F.col("sync_status").isin(*ACTIONS["import"]), F.lit("import")) \
        .when(F.col("sync_status").isin(*ACTIONS["update"]), F.lit("update"))
    return comparison.withColumn("action", action).filter(F.col("action").isNotNull())


def sync_report(comparison: DataFrame) -> DataFrame:
    """Counts of lines to import and to update (one row, both always present)."""
    c = comparison
    return c.agg(
        F.sum(F.when(c.sync_status.isin(*ACTIONS["import"]), 1).otherwise(0)).cast("bigint").alias("to_import"),
        F.sum(F.when(c.sync_status.isin(*ACTIONS["update"]), 1).otherwise(0)).cast("bigint").alias("to_update"),
    ).select(F.coalesce("to_import", F.lit(0).cast("bigint")).alias("to_import"),
             F.coalesce("to_update", F.lit(0).cast("bigint")).alias("to_update"))


SAMPLE_ORDER = ["shopify_order_number", "shopify_sku", "shopify_product_name", "shopify_quantity",
                "shopify_price", "odoo_quantity", "odoo_price", "sync_status"]


def sync_report_samples(comparison: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` lines per action in a total order (a top-k per action).

    A row number per action with a bound: each task keeps its first ``n`` rows of
    an action before anything moves, and the comparison is read once.
    """
    acts = sync_actions(comparison).select("action", *SAMPLE_ORDER)
    first = Window.partitionBy("action").orderBy(*[F.col(c).asc_nulls_first() for c in SAMPLE_ORDER])
    return acts.withColumn("__k", F.row_number().over(first)).filter(F.col("__k") <= n).drop("__k")


def paid_orders(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("financial_status") == F.lit(PAID_STATUS))


def _instant(lines: DataFrame, column: str):
    """The column's instant: text with or without offset is parsed, a time without zone is UTC."""
    kind = lines.schema[column].dataType.simpleString()
    if kind == "timestamp":
        return F.col(column)
    return parse_offset_ts(column if kind == "string" else F.substring(F.col(column).cast("timestamp_ntz").cast("string"), 1, 19))


def map_legacy_skus(lines: DataFrame, legacy: DataFrame, suffix: str = LEGACY_SKU_SUFFIX) -> DataFrame:
    """Replace a line's SKU by ``base_sku || suffix`` when the legacy table
    maps it to a non-null base; duplicates in the lookup fan out. Adds the paid date's parts and the plant's name."""
    lk = broadcast_if_small(legacy.select("legacy_sku", "base_sku"))
    j = lines.join(lk, lines["sku"] == lk["legacy_sku"], "left")
    sku = F.when(F.col("base_sku").isNull(), F.col("sku")).otherwise(null_concat("base_sku", F.lit(suffix)))
    return j.select("order_name", sku.alias("sku"), "email", "financial_status", "fulfillment_status", "paid_at", "quantity",
                    "product_name", "price", "billing_name", "tags",
                    *date_parts(_instant(lines, "paid_at"), null_year="0"), plant_name("product_name").alias("plantname"))


def order_flow_report(mapped: DataFrame, erp: DataFrame) -> DataFrame:
    """Report rows: mapped storefront lines with the ERP delivery status,
    matched on ERP order name and SKU. Sorting is left to the writer."""
    e = erp.select(F.col("erp_name").alias("__n"), F.col("sku").alias("__s"), "delivery_status")
    j = mapped.join(e, (mapped["order_name"] == e["__n"]) & (mapped["sku"] == e["__s"]), "left")
    return j.select(
        F.col("order_name").alias("name"), F.col("billing_name").alias("customer"), "sku",
        F.col("product_name").alias("item"), F.col("paid_at").alias("paid_date"),
        F.col("quantity").alias("qty"), F.col("financial_status").alias("payment"),
        F.col("fulfillment_status").alias("shipment"), "delivery_status", "tags")


def report_order():
    """Order name descending, compared as text."""
    return [F.col("name").desc_nulls_last()]


def latest_order(lines: DataFrame) -> DataFrame:
    """Creation time of the highest numbered order name (``#<n>``), as a top-1."""
    named = lines.filter(F.col("order_name").startswith("#"))
    return (named.select("created_at",
                         order_number("order_name").alias("order_num"))
            .orderBy(F.col("order_num").desc(), F.col("created_at").asc_nulls_first()).limit(1))


def paid_date_parts(export: DataFrame, ts_col: str = "paid_at", keep=("name",)) -> DataFrame:
    """Paid time parsed with its offset, printed in UTC, with date parts, beside the columns ``keep``."""
    ts = parse_offset_ts(ts_col)
    return export.select(
        *keep,
        F.when(ts.isNotNull(), iso_utc(ts)).alias("paid_at"),
        *date_parts(ts, null_year="0", suffix="paid"))


def with_plant_name(lines: DataFrame, keep=("order_name", "sku", "product_name")) -> DataFrame:
    return lines.select(*keep, plant_name("product_name").alias("plantname"))
