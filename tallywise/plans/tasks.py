"""The four user tasks end to end: read landing frames, build, write reports.

Each task takes landing DataFrames (so any source can feed it) and an output
folder; report writers apply the sorts the reports are read in. Output
folders should sit in shared storage on a cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.plans import imports as I
from tallywise.plans import orders as O
from tallywise.plans import pull as P
from tallywise.plans import stock as S
from tallywise.sources.sinks import write_report


@dataclass
class OrderFlowInputs:
    storefront_lines: DataFrame
    erp_lines: DataFrame
    legacy_lookup: DataFrame


def run_time(spark) -> str:
    """The cluster's time as ISO text: one value for a run."""
    return spark.sql("select date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")").first()[0]


def order_flow(inp: OrderFlowInputs, out_dir: str, paid_only: bool = True, as_of: str | None = None) -> dict[str, bool]:
    """Legacy SKU map -> report; comparison -> table (with its time, ``as_of`` or the run's) and status counts."""
    lines = O.paid_orders(inp.storefront_lines) if paid_only else inp.storefront_lines
    report = O.order_flow_report(O.map_legacy_skus(lines, inp.legacy_lookup), inp.erp_lines)
    comparison = O.compare_orders(lines, inp.erp_lines, as_of or run_time(inp.erp_lines.sparkSession))
    return {
        "excel_report": write_report(report, f"{out_dir}/excel_report", order=O.report_order()),
        "order_comparison": write_report(comparison, f"{out_dir}/order_comparison", fmt="parquet"),
        "sync_status_counts": write_report(O.sync_status_counts(comparison), f"{out_dir}/sync_status_counts"),
    }


@dataclass
class StockInputs:
    quants: DataFrame
    sizes: DataFrame
    products: DataFrame
    inventory: DataFrame


def stock_cross_reference(inp: StockInputs, out_dir: str) -> dict[str, bool]:
    from tallywise.session import stage_rows
    stock = stage_rows(S.clean_odoo_stock(inp.quants), "stock")  # read by five reports
    totals = S.total_by_location(stock, inp.sizes)
    xref = S.stock_cross_reference(totals, S.combined_storefront(inp.products, inp.inventory),
                                   S.location_counts(totals), S.size_mismatches(stock, inp.products))
    extended = S.cross_reference_extended(stock, inp.inventory)
    return {
        "stock_cross_reference": write_report(xref, f"{out_dir}/stock_cross_reference", order=S.xref_order()),
        "stock_cross_reference_extended": write_report(extended, f"{out_dir}/stock_cross_reference_extended",
                                                       order=S.extended_order()),
        "loc_count": write_report(S.location_counts(totals), f"{out_dir}/loc_count",
                                  order=S.loc_count_order()),
        "sku_mismatches": write_report(S.sku_size_swaps(stock, inp.inventory), f"{out_dir}/sku_mismatches"),
    }


@dataclass
class PullInputs:
    picking: DataFrame
    quants: DataFrame


def pull_sheet(inp: PullInputs, out_dir: str) -> dict[str, bool]:
    """Pull sheet, order targets, alternative stock; empty results are skipped."""
    return {
        "pullsheet": write_report(P.pullsheet(inp.picking), f"{out_dir}/03_pullsheet",
                                  order=P.PULLSHEET_ORDER, skip_empty=True),
        "order_targets": write_report(P.order_targets(inp.picking), f"{out_dir}/04_order_targets",
                                      order=P.TARGETS_ORDER, skip_empty=True),
        "alt_stock": write_report(P.alternative_stock(P.stock_levels(inp.quants), inp.picking),
                                  f"{out_dir}/05_alt_inventory", order=P.ALT_STOCK_ORDER, skip_empty=True),
    }


@dataclass
class ImportInputs:
    order_export: DataFrame      # canonical landing names, see imports.EXPORT_RENAME
    existing_orders: DataFrame
    existing_contacts: DataFrame
    row_order: tuple = ("line_no",)  # columns that sort the export in file order (files.read_csv adds one)


def import_candidates(inp: ImportInputs, out_dir: str) -> dict[str, bool]:
    export = I.export_frame(inp.order_export, inp.row_order)
    return {
        "contacts": write_report(I.import_contacts(export, inp.existing_contacts), f"{out_dir}/01_contacts_upload"),
        "orders": write_report(I.import_orders(export, inp.existing_orders), f"{out_dir}/02_orders_upload"),
    }


def refresh_storefront_orders(docs: DataFrame, out_path: str, as_of: str, days: int | None = 90) -> bool:
    """Storefront order refresh: orders created in the look-back window
    (``days=None`` keeps all) flattened to lines, paid lines only, paid date
    parts added, then a full replace of the table with a surrogate key in order
    of creation (orders of one instant by name, then their lines)."""
    from tallywise.constants import PAID_STATUS
    from tallywise.functions import date_parts, iso_utc, lookback
    from tallywise.plans.flatten import flatten_orders
    from tallywise.sources.sinks import replace_table

    recent = docs.filter(lookback(F.try_to_timestamp(F.col("created_at")), as_of, days, zone="UTC"))
    lines = flatten_orders(recent)
    ts = F.try_to_timestamp(F.col("paid_at"))
    out = lines.filter(F.col("financial_status") == PAID_STATUS).select(
        "*", F.when(ts.isNotNull(), iso_utc(ts)).alias("paid_at_utc"), *date_parts(ts, null_year="0"))
    created = F.try_to_timestamp(F.col("created_at"))
    replace_table(out, out_path, [created, F.length("name"), "name", "lineitem_number"])
    return True


def refresh_erp_orders(erp: dict, out_path: str) -> bool:
    """ERP order refresh: headers, lines, products and partners assembled to
    line rows, stamped with the load's time and fully replaced (the ERP side
    always reads everything)."""
    from tallywise.plans.flatten import erp_order_lines
    from tallywise.sources.sinks import replace_table

    rows = erp_order_lines(erp["erp_orders"], erp["erp_order_lines"], erp["erp_products"],
                           erp["erp_partners"], erp["erp_states"], erp["erp_countries"])
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    rows = rows.withColumns({"created_at": now, "updated_at": now})
    replace_table(rows, out_path, ["odoo_id", "line_number"], key="row_id", as_text=False)
    return True


def import_bulk_inventory(lines: DataFrame, out_dir: str, as_of: str) -> dict[str, bool]:
    """Bulk-export import: inventory and product tables and the load stamp, replaced
    together in one step (``versions.read_table(spark, out_dir, table)`` reads them)."""
    from tallywise.plans.inventory import bulk_inventory, classify_records
    from tallywise.sources.sinks import last_update_table, stamp
    from tallywise.sources.versions import replace_tables

    inventory, products = bulk_inventory(classify_records(lines))
    replace_tables({"shopify_inventory": stamp(inventory, as_of), "shopifyproducts": products,
                    "last_update": last_update_table(lines.sparkSession, as_of)}, out_dir)
    return {"shopify_inventory": True, "shopifyproducts": True, "last_update": True}


def import_inventory_csv(exports: str, stock: DataFrame, out_dir: str, as_of: str) -> dict[str, bool]:
    """Inventory CSV import: the newest export matching ``exports`` (a glob) grouped by SKU, stamped and
    replaced as a table in the order of its SKUs; the extended cross-reference with the ERP's cleaned
    ``stock``, and the report of its significant mismatches, largest first. An empty report is not written."""
    from tallywise.constants import CSV_RENAME
    from tallywise.plans.inventory import INVENTORY_ORDER, inventory_from_csv
    from tallywise.sources.files import newest_file, read_csv
    from tallywise.sources.sinks import ranked, stamp
    from tallywise.sources.versions import read_table, replace_tables

    spark = stock.sparkSession
    newest = newest_file(spark, exports)
    schema = ", ".join(f"`{h}` string" for h in CSV_RENAME)
    inventory = inventory_from_csv(read_csv(spark, newest, schema, position="line_no"), "line_no")
    replace_tables({"shopify_inventory": stamp(ranked(inventory, INVENTORY_ORDER, "row_id"), as_of)}, out_dir)
    extended = S.cross_reference_extended(stock, read_table(spark, out_dir, "shopify_inventory"))
    return {
        "shopify_inventory": True,
        "stock_cross_reference_extended": write_report(extended, f"{out_dir}/reports/stock_cross_reference_extended",
                                                       order=S.extended_order(), skip_empty=True),
        "mismatches": write_report(S.significant_mismatches(extended), f"{out_dir}/reports/mismatches",
                                   order=S.mismatch_order(), skip_empty=True),
    }


def import_catalog(pages_path: str, spark, out_dir: str, as_of: str, overrides: DataFrame | None = None,
                   keep_broken: bool = False) -> dict[str, bool]:
    """Catalogue import: landed pages flattened to the inventory and product tables, replaced together with the
    load stamp. ``overrides`` are the listed SKUs' own figures. Broken pages fail the
    import, or with ``keep_broken`` become the table ``rejects`` of the same commit."""
    from tallywise.plans.inventory import PAGE_SCHEMA, apply_overrides, catalog_flatten_parsed, catalog_tables
    from tallywise.session import stage_rows
    from tallywise.sources.rejects import read_documents
    from tallywise.sources.sinks import last_update_table, stamp
    from tallywise.sources.versions import replace_tables

    pages = read_documents(spark, pages_path, PAGE_SCHEMA, keep_broken)
    inventory, products = catalog_tables(stage_rows(catalog_flatten_parsed(pages.rows), "catalogue"))
    if overrides is not None:
        inventory = apply_overrides(inventory, overrides)
    tables = {"shopify_inventory": stamp(inventory, as_of), "shopifyproducts": products, "last_update": last_update_table(spark, as_of)}
    if keep_broken:
        tables["rejects"] = pages.rejects
    replace_tables(tables, out_dir)
    return {name: True for name in tables}
