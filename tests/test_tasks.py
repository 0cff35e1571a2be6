"""The four user tasks write their reports (run on the small tables)."""

import uuid

from tallywise.plans import tasks as T
from tallywise.session import scratch_path
from tallywise.sources.fixtures import fixtures, paired_quants
from tallywise.sources.versions import read_table
from tests.conftest import SMALL


def test_tasks_write_reports(spark):
    fx = fixtures(spark, SMALL)
    out = scratch_path(spark, f"tallywise-tests/{uuid.uuid4().hex}")
    assert all(T.order_flow(T.OrderFlowInputs(fx.storefront_lines, fx.erp_lines, fx.legacy_lookup),
                            f"{out}/of").values())
    assert all(T.stock_cross_reference(T.StockInputs(paired_quants(fx.quants), fx.sizes, fx.storefront_products,
                                                     fx.storefront_inventory), f"{out}/sx").values())
    assert all(T.pull_sheet(T.PullInputs(fx.picking, paired_quants(fx.quants)), f"{out}/pull").values())
    assert all(T.import_candidates(T.ImportInputs(fx.order_export, fx.existing_orders, fx.existing_contacts, ("l_orderkey", "line_no")),
                                   f"{out}/imp").values())
    compared = spark.read.parquet(f"{out}/of/order_comparison")
    assert compared.count() > 0 and compared.filter("comparison_date is null").isEmpty()
    assert compared.select("comparison_date").distinct().count() == 1
    back = spark.read.option("header", True).csv(f"{out}/pull/03_pullsheet")
    assert back.count() == fx.picking.filter("quantity > 0").count()
    assert back.columns == ["ord", "item", "location", "qty", "on_hand"]
    from pyspark.sql import functions as F
    counts = (spark.read.option("header", True).csv(f"{out}/sx/loc_count")
              .select("loc_count", "product_id", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("at")))
    rows = sorted(counts.collect(), key=lambda r: (r.f.rsplit("/", 1)[1], r["at"]))
    assert [-int(r.loc_count) for r in rows] == sorted(-int(r.loc_count) for r in rows)
    assert len({r.product_id for r in rows}) == len(rows)


def test_refresh_and_import_tasks(spark):
    from pyspark.sql import functions as F
    from tallywise.sources.nested import bulk_export_lines, erp_landing, order_documents
    out = scratch_path(spark, f"tallywise-tests/{uuid.uuid4().hex}")
    docs = order_documents(spark, SMALL)
    assert T.refresh_storefront_orders(docs, f"{out}/shopify_orders", "1998-08-02 00:00:00", days=None)
    t = read_table(spark, f"{out}/shopify_orders")
    paid_lines = docs.filter("financial_status = 'paid'").select(
        F.greatest(F.coalesce(F.size("line_items"), F.lit(0)), F.lit(1)).alias("n"))
    assert t.count() == paid_lines.agg(F.sum("n")).first()[0]
    assert sorted(r.id for r in t.select("id").collect()) == list(range(1, t.count() + 1))
    assert set(t.columns) >= {"paid_at_utc", "day_paid", "month_paid", "year_paid"}
    rows = sorted(t.select("id", "created_at", "name", "lineitem_number").collect())
    keys = [(r.created_at, int(r.name[1:]), int(r.lineitem_number)) for r in rows]
    assert keys == sorted(keys)  # by creation; #9 before #10
    recent = T.refresh_storefront_orders(docs, f"{out}/shopify_orders_90d", "1998-08-02 00:00:00", days=90)
    assert recent and read_table(spark, f"{out}/shopify_orders_90d").count() < t.count()

    assert T.refresh_erp_orders(erp_landing(spark, SMALL), f"{out}/odoo_orders")
    erp = read_table(spark, f"{out}/odoo_orders")
    assert {"customer_email", "shipping_phone", "billing_zip", "notes", "created_at", "updated_at"} <= set(erp.columns)
    assert erp.filter("created_at is null or updated_at is null").isEmpty()
    assert erp.count() > 0

    assert all(T.import_bulk_inventory(bulk_export_lines(spark, SMALL), f"{out}/inv", "2026-01-01").values())
    assert read_table(spark, f"{out}/inv", "last_update").count() == 1


def test_write_once_ignores_unfinished_folder(spark):
    from tallywise.sources import sinks
    path = scratch_path(spark, f"tallywise-tests/{uuid.uuid4().hex}/legacy")
    df = spark.range(5).toDF("x")
    # a crashed load: folder with data files but no commit marker
    df.limit(2).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    assert not sinks.table_exists(spark, path)
    assert sinks.write_once(df, path)
    assert spark.read.parquet(path).count() == 5
    assert sinks.table_exists(spark, path)
    assert not sinks.write_once(spark.range(9).toDF("x"), path)
    assert spark.read.parquet(path).count() == 5


def test_json_lines_keep_file_order_across_part_files(spark):
    from pyspark.sql import functions as F
    from tallywise.sources.files import read_json_lines
    path = scratch_path(spark, f"tallywise-tests/{uuid.uuid4().hex}/lines")
    lines = spark.range(0, 5000).select(F.to_json(F.struct(F.col("id").alias("n"))).alias("value"), "id")
    lines.repartitionByRange(7, "id").sortWithinPartitions("id").select("value").write.text(path)
    back = read_json_lines(spark, path).select(F.get_json_object("value", "$.n").cast("long").alias("n"), "line_no")
    ordered = [r.n for r in back.orderBy("line_no").collect()]
    assert ordered == list(range(5000))


def test_empty_inputs_write_no_report(spark):
    """An empty transfer sheet or ERP side goes through its task; empty reports are skipped."""
    from tallywise.sources.files import path_exists
    fx = fixtures(spark, SMALL)
    out = scratch_path(spark, f"tallywise-tests/{uuid.uuid4().hex}")
    wrote = T.pull_sheet(T.PullInputs(fx.picking.limit(0), paired_quants(fx.quants)), f"{out}/pull")
    assert wrote == {"pullsheet": False, "order_targets": False, "alt_stock": False}
    assert not path_exists(spark, f"{out}/pull/03_pullsheet")
    assert all(T.order_flow(T.OrderFlowInputs(fx.storefront_lines, fx.erp_lines.limit(0), fx.legacy_lookup), f"{out}/of",
                            as_of="2026-01-01T00:00:00").values())
    compared = spark.read.parquet(f"{out}/of/order_comparison")
    assert {r.sync_status for r in compared.filter("shopify_order_number is not null").select("sync_status").distinct().collect()} == {"Missing in Odoo"}
    assert compared.filter("odoo_order_id is not null").isEmpty()
    assert {r.comparison_date for r in compared.select("comparison_date").distinct().collect()} == {"2026-01-01T00:00:00"}
    assert all(T.order_flow(T.OrderFlowInputs(fx.storefront_lines.limit(0), fx.erp_lines.limit(0), fx.legacy_lookup), f"{out}/no").values())
    assert spark.read.parquet(f"{out}/no/order_comparison").count() == 0


def test_inventory_csv_import_task(spark):
    from pyspark.sql import functions as F
    from tallywise.constants import CSV_RENAME
    from tallywise.plans.inventory import inventory_by_sku
    from tallywise.plans.stock import clean_odoo_stock
    from tallywise.sources.files import write_csv
    fx = fixtures(spark, SMALL)
    out = scratch_path(spark, f"tallywise-tests/{uuid.uuid4().hex}")
    heads = [F.col(c).alias(h) for h, c in CSV_RENAME.items() if c != "handle"]
    for name, rows in (("old", fx.inventory_csv.limit(3)), ("new", fx.inventory_csv)):
        write_csv(rows.orderBy("row_idx", "sku").select(*heads).coalesce(1), f"{out}/exports/{name}")
    wrote = T.import_inventory_csv(f"{out}/exports/*/part-*", clean_odoo_stock(paired_quants(fx.quants)), f"{out}/inv", "2026-01-01")
    assert all(wrote.values())
    table = read_table(spark, f"{out}/inv", "shopify_inventory")
    got = [tuple(r) for r in table.orderBy("row_id").drop("row_id", "import_date").collect()]
    want = sorted(tuple(r) for r in inventory_by_sku(fx.inventory_csv).collect())
    assert got == want and table.filter("import_date = '2026-01-01'").count() == len(want)  # by SKU
    report = (spark.read.option("header", True).csv(f"{out}/inv/reports/mismatches")
              .select(F.abs(F.col("shopify_on_hand").cast("double") - F.col("odoo_quantity").cast("double")).alias("d"),
                      F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("at")))
    gaps = [r.d for r in sorted(report.collect(), key=lambda r: (r.f.rsplit("/", 1)[1], r["at"]))]
    assert len(gaps) > 3 and gaps == sorted(gaps, reverse=True) and gaps[-1] > 5


def test_catalogue_import_task(spark):
    from tallywise.plans.inventory import catalog_flatten, overrides_frame
    from tallywise.sources.nested import catalog_pages
    import pytest
    from pyspark.sql import functions as F
    out = scratch_path(spark, f"tallywise-tests/{uuid.uuid4().hex}")
    pages = catalog_pages(spark, SMALL)
    pages.select("body").write.text(f"{out}/pages")
    sku = catalog_flatten(pages).first().sku
    own = overrides_frame(spark, [(sku, 41.0, 41.0, 0.0, 0.0, 0.0)])
    assert set(T.import_catalog(f"{out}/pages", spark, f"{out}/cat", "2026-01-01", own)) == {"shopify_inventory", "shopifyproducts", "last_update"}
    inventory = read_table(spark, f"{out}/cat", "shopify_inventory")
    assert inventory.count() == catalog_flatten(pages).count() == read_table(spark, f"{out}/cat", "shopifyproducts").count()
    hit = inventory.filter(F.col("sku") == sku).first()
    assert (hit.on_hand, hit.committed, hit.available, hit.import_date) == (41.0, 41.0, 0.0, "2026-01-01")
    spark.createDataFrame([('{"data": {"products"',)], "value string").write.mode("append").text(f"{out}/pages")
    with pytest.raises(Exception, match="not a document"):
        T.import_catalog(f"{out}/pages", spark, f"{out}/cat", "2026-01-02")
    assert read_table(spark, f"{out}/cat", "last_update").first().last_updated == "2026-01-01"  # the failed import left all as it was
    T.import_catalog(f"{out}/pages", spark, f"{out}/cat", "2026-01-03", keep_broken=True)
    assert read_table(spark, f"{out}/cat", "rejects").count() == 1
    assert read_table(spark, f"{out}/cat", "shopify_inventory").count() == inventory.count()


def test_size_sources_in_order(spark):
    from tallywise.plans.stock import size_dimension
    erp = spark.createDataFrame([("01G", 1.0)], "name string, container_capacity double")
    spark.createDataFrame([("07G", 7.0)], "name string, container_capacity double").createOrReplaceTempView("plant_sizes_of_a_test")
    table, csv = lambda: spark.table("plant_sizes_of_a_test"), lambda: spark.read.parquet("/tmp/there/is/no/csv")
    assert size_dimension(lambda: erp, csv, table).first().name == "01G"
    assert size_dimension(lambda: erp.select("name"), csv, table).first().name == "07G"
    assert size_dimension(lambda: erp.limit(0), csv).count() == 0
    assert size_dimension(csv).columns == ["name", "container_capacity"]


def test_a_look_back_lists_its_own_days(spark):
    from pyspark.sql import functions as F
    from tallywise.sources.landing import land_by_day, read_window
    path = scratch_path(spark, f"tallywise-tests/{uuid.uuid4().hex}/orders")
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").filter("o_orderdate >= timestamp '1998-06-01'")
    land_by_day(orders, "o_orderdate", path)
    got = read_window(spark, path, "o_orderdate", "1998-07-31 12:00:00", 20)
    want = orders.filter("o_orderdate >= timestamp '1998-07-11 12:00:00'")
    assert 0 < got.count() == want.count() < orders.count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(landed_day" in plan
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    read = {str(r[0]) for r in got.select(F.regexp_extract(F.input_file_name(), "landed_day=([0-9-]+)", 1)).distinct().collect()}
    assert min(read) >= "1998-07-11"
    assert read_window(spark, path, "o_orderdate", "x", None).count() == orders.count()
