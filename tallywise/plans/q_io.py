"""Registered source/sink queries. They write under the shared scratch
folder (``spark.checkpoint.dir``) and read the written data back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallywise.plans import stock as S
from tallywise.plans.q_stock import XREF_SQL
from tallywise.plans.registry import query
from tallywise.session import scratch_path
from tallywise.sources import sinks
from tallywise.sources.files import newest_file, read_csv, write_csv
from tallywise.sources.fixtures import fixtures, with_clause
from tallywise.sources.versions import read_table

AS_OF = "2026-01-01T00:00:00"
INVENTORY_CSV_SCHEMA = ("sku string, title string, option_value string, available string, on_hand string, "
                        "committed string, unavailable string, incoming string, row_idx bigint")


def _run_dir(spark, tag: str) -> str:
    return scratch_path(spark, f"tallywise/{tag}/{uuid.uuid4().hex}")


@query("latest_file", with_clause("inventory_csv") + "select * from inventory_csv where row_idx % 3 = 1")
def q_latest_file(spark, sf_dir):
    """Three exports land one after the other; the last one, which holds row_idx % 3 = 1, is read."""
    inv = fixtures(spark, sf_dir).inventory_csv
    base = _run_dir(spark, "latest_file")
    for k in (0, 2, 1):
        write_csv(inv.filter(F.col("row_idx") % 3 == k), f"{base}/inventory_export_{k}")
    newest = newest_file(spark, f"{base}/inventory_export*/part-*")
    return read_csv(spark, newest.rsplit("/", 1)[0], INVENTORY_CSV_SCHEMA)


_TEXT_COLS = ["order_name", "sku", "product_name", "quantity", "price", "financial_status", "paid_at",
              "billing_name", "line_no", "l_orderkey"]


@query("table_replace", with_clause("storefront_lines") + "select "
       + ", ".join(f"cast({c} as varchar) as {c}" for c in _TEXT_COLS)
       + ", cast(row_number() over (order by l_orderkey, line_no) as bigint) as id from storefront_lines")
def q_table_replace(spark, sf_dir):
    lines = fixtures(spark, sf_dir).storefront_lines
    path = _run_dir(spark, "table_replace")
    sinks.replace_table(sinks.insert_by_name(lines, _TEXT_COLS), path, ["l_orderkey", "line_no"])
    return read_table(spark, path)


@query("table_guard", with_clause("legacy_lookup") + "select * from legacy_lookup")
def q_table_guard(spark, sf_dir):
    """Loads the lookup twice into a folder of this run; the second load must be skipped."""
    path = _run_dir(spark, "legacy_lookup")
    legacy = fixtures(spark, sf_dir).legacy_lookup
    if not sinks.write_once(legacy, path) or sinks.write_once(legacy.limit(0), path):
        raise RuntimeError("the table guard did not hold")
    return spark.read.parquet(path)


@query("table_guard_catalog", with_clause("legacy_lookup") + "select * from legacy_lookup")
def q_table_guard_catalog(spark, sf_dir):
    """The same guard on a table of the catalogue, read by its name."""
    table = f"tallywise_legacy_{uuid.uuid4().hex}"
    legacy, path = fixtures(spark, sf_dir).legacy_lookup, _run_dir(spark, "legacy_table")
    if not sinks.load_table_once(legacy, table, path) or sinks.load_table_once(legacy.limit(0), table, path):
        raise RuntimeError("the table guard did not hold")
    return spark.table(table)


@query("table_replace_catalog", with_clause("storefront_inventory") + "select * from storefront_inventory where available > 0")
def q_table_replace_catalog(spark, sf_dir):
    """Two full replaces of a table of the catalogue; the second one's rows count."""
    table = f"tallywise_inventory_{uuid.uuid4().hex}"
    inventory, store = fixtures(spark, sf_dir).storefront_inventory, _run_dir(spark, "inventory_table")
    sinks.replace_catalog_table(inventory, table, store)
    return sinks.replace_catalog_table(inventory.filter("available > 0"), table, store)


XREF_SCHEMA = ("product_id string, location_id string, loc_count bigint, odoo_onhand_qty double, "
               "odoo_available_qty double, shopify_onhand_qty double, shopify_available_qty double, "
               "shopify_committed_qty double, shopify_unavailable_qty double, diff_onhand double, "
               "diff_available double, title string, status string, potential_correct_sku string, "
               "potential_correct_size string, size_mismatch_note string")


@query("report_write", XREF_SQL)
def q_report_write(spark, sf_dir):
    from tallywise.plans.q_stock import q_stock_xref
    path = _run_dir(spark, "report_write")
    sinks.write_report(q_stock_xref(spark, sf_dir), path, order=S.xref_order())
    return read_csv(spark, path, XREF_SCHEMA)


@query("load_stamp", with_clause("storefront_inventory") + f"""
select 'shopify_inventory' as table_name, cast(count(*) as bigint) as n_rows, '{AS_OF}' as import_date
from storefront_inventory
union all
select 'last_update', cast(1 as bigint), '{AS_OF}'""")
def q_load_stamp(spark, sf_dir):
    base = _run_dir(spark, "load_stamp")
    inv = sinks.stamp(fixtures(spark, sf_dir).storefront_inventory, AS_OF)
    inv.write.mode("overwrite").parquet(f"{base}/shopify_inventory")
    sinks.last_update_table(spark, AS_OF).write.mode("overwrite").parquet(f"{base}/last_update")
    a = (spark.read.parquet(f"{base}/shopify_inventory").groupBy("import_date")
         .agg(F.count(F.lit(1)).alias("n_rows"))
         .select(F.lit("shopify_inventory").alias("table_name"), "n_rows", "import_date"))
    b = (spark.read.parquet(f"{base}/last_update").groupBy(F.col("last_updated").alias("import_date"))
         .agg(F.count(F.lit(1)).alias("n_rows"))
         .select(F.lit("last_update").alias("table_name"), "n_rows", "import_date"))
    return a.unionByName(b)
