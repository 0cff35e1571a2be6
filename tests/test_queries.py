"""Every registered query against its DuckDB oracle on the small tables, and
plan properties of the key joins."""

import duckdb
import pytest

import __spark_entry__ as E


def library() -> dict:
    """The registered queries of the library itself."""
    from tallywise.plans.registry import QUERIES, load_all
    load_all()
    return dict(QUERIES)

from tallywise.sources.tables import TABLES
from tests.conftest import SMALL


def _norm(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return f"{v:.6g}"
    return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted({k: v for k, v in E.oracle_sql().items() if k in library()}))
def test_query_matches_oracle(spark, duck, key):
    df = library()[key](spark, SMALL)
    res = duck.execute({k: v for k, v in E.oracle_sql().items() if k in library()}[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(ocols, res.fetchall())


def test_every_query_has_oracle():
    assert set(library()) == set({k: v for k, v in E.oracle_sql().items() if k in library()})


def test_entry_runs(spark):
    assert E.entry(spark).count() == 5


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_size_mismatch_has_no_cartesian(spark):
    plan = _plan(library()["size_mismatch"](spark, SMALL))
    assert "CartesianProduct" not in plan


def test_no_python_udf_in_any_plan(spark):
    for key, fn in library().items():
        if key in {"latest_file", "table_replace", "table_guard", "report_write", "load_stamp"}:
            continue
        plan = _plan(fn(spark, SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


def test_alt_stock_is_equi_semi_join(spark):
    plan = _plan(library()["alt_stock"](spark, SMALL))
    assert "LeftSemi" in plan and "BroadcastNestedLoopJoin" not in plan


def test_sync_counts_sum_to_comparison(spark):
    q = library()
    total = q["order_compare"](spark, SMALL).count()
    assert sum(r["n_lines"] for r in q["sync_status_counts"](spark, SMALL).collect()) == total


def test_parquet_pushdown_and_pruning(spark):
    df = library()["lookback_filter"](spark, SMALL).select("o_orderkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp" in plan


def test_anti_and_semi_partition_the_export(spark):
    from pyspark.sql import functions as F
    from tallywise.sources.fixtures import fixtures
    fx = fixtures(spark, SMALL)
    exp = fx.order_export.filter(F.col("sku").isNotNull())
    known = fx.existing_orders
    anti = exp.join(known, "name", "left_anti").count()
    semi = exp.join(known, "name", "left_semi").count()
    assert anti + semi == exp.count()
    assert library()["import_orders_new"](spark, SMALL).count() == anti


def test_line_numbers_are_one_to_n(spark):
    from pyspark.sql import functions as F
    df = library()["line_numbers"](spark, SMALL)
    agg = df.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.min("line_no").alias("lo"),
                                       F.max("line_no").alias("hi"),
                                       F.count_distinct("line_no").alias("d"))
    assert agg.filter("lo != 1 or hi != n or d != n").count() == 0


def test_no_cartesian_or_nested_loop_when_broadcast_is_off(spark):
    """At scale nothing is small enough to broadcast; no plan may then fall
    back to a cartesian product or a nested-loop join."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for key, fn in library().items():
            plan = _plan(fn(spark, SMALL))
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_comparison_is_one_full_outer_join_over_sliced_keys(spark):
    """One full outer join; keys with many rows, whole or null, are dealt into slices by a broadcast list."""
    plan = _plan(library()["order_compare"](spark, SMALL))
    assert plan.count("FullOuter") == 1 and "CartesianProduct" not in plan
    join = next(line for line in plan.splitlines() if "FullOuter" in line)
    assert "__li" in join and "__rj" in join and "TakeOrderedAndProject" in plan


def test_sides_built_from_part_are_not_broadcast(spark):
    """Their size is underestimated, so at size they would not fit the driver or a task."""
    for key in ("size_mismatch", "inventory_csv_by_sku", "storefront_combined", "stock_xref_extended"):
        plan = _plan(library()[key](spark, SMALL)).split("Initial Plan")[-1]
        joins = [ln for ln in plan.splitlines() if "BroadcastHashJoin" in ln and ("sku" in ln or "default_code" in ln)]
        assert not joins and "SortMergeJoin" in plan, (key, joins)


def test_landed_order_documents_are_compressed(spark):
    """The documents of the file variants are some ten times the tables; they land compressed."""
    import glob
    from tallywise.session import scratch_path
    folder = scratch_path(spark, "tallywise/order_pages").removeprefix("file:")
    for key in ("flatten_orders_file", "flatten_orders_rejects"):
        before = set(glob.glob(f"{folder}/*"))
        library()[key](spark, SMALL)
        files = [f for d in set(glob.glob(f"{folder}/*")) - before for f in glob.glob(f"{d}/part-*")]
        assert files and all(f.endswith(".gz") for f in files), key


def test_order_documents_gather_lines_without_a_collecting_aggregate(spark):
    plan = _plan(library()["flatten_orders"](spark, SMALL))
    assert "ObjectHashAggregate" not in plan and "collect_list" in plan


def test_storefront_lines_in_spark_are_the_view(spark):
    from tallywise.sources.fixtures import SPARK_TEXT, VIEWS, fixtures
    fixtures(spark, SMALL)
    shared, own = spark.sql(VIEWS["storefront_lines"]), spark.sql(SPARK_TEXT["storefront_lines"])
    assert own.schema == shared.schema and own.count() == shared.count() > 0
    assert own.exceptAll(shared).count() == 0


def test_storefront_texts_are_not_shuffled_to_the_joins(spark):
    """Lines meet their orders with their columns as they are, and orders their customers before that."""
    from tallywise.sources.fixtures import fixtures
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = fixtures(spark, SMALL).storefront_lines.select("order_name", "sku", "product_name", "email")
        plan = lines._jdf.queryExecution().optimizedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = [i for i, ln in enumerate(plan) if "Join Inner" in ln]
    assert len(joins) == 3 and not any("FAM-" in ln for ln in plan[joins[0]:])
    assert "c_custkey" in plan[joins[-1]]


def test_partners_reach_headers_as_by_three_joins(spark):
    """Ids, headers and partners that repeat or are null: the rows of a left join per role."""
    from collections import Counter
    from pyspark.sql import functions as F
    from tallywise.plans.flatten import PARTNER_ROLES, with_partners
    orders = spark.createDataFrame(
        [(1, 10, 10, 11, "a"), (1, 10, 12, None, "b"), (1, 10, 12, None, "b"), (2, 11, 99, 10, "c"), (3, None, None, None, "d"),
         (None, 10, 11, 12, "e"), (None, 10, 11, 12, "e"), (None, None, 10, 99, "f")],
        "id bigint, partner_id bigint, partner_invoice_id bigint, partner_shipping_id bigint, note string")
    partners = spark.createDataFrame([(10, "P"), (11, "Q"), (11, "Q"), (11, None), (12, "R"), (None, "N")], "id bigint, name string")
    plain = orders
    for role, key in PARTNER_ROLES.items():
        p = partners.select(F.col("id").alias(f"{role}_id"), F.col("name").alias(f"{role}_name"))
        plain = plain.join(p, F.col(key) == F.col(f"{role}_id"), "left").drop(f"{role}_id")
    got = with_partners(orders, partners).select(*orders.columns, *[F.col(f"{r}.name").alias(f"{r}_name") for r in PARTNER_ROLES])
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, plain.collect()))


def test_erp_headers_are_neither_staged_nor_shuffled_per_role(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(library()["erp_orders_assemble"](spark, SMALL)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert not any("erp-headers" in ln for ln in plan)
    wide = [i for i, ln in enumerate(plan) if "FileScan" in ln and "o_totalprice" in ln]
    above = [next(ln for ln in reversed(plan[:i]) if "Exchange hashpartitioning" in ln) for i in wide]
    assert above and all("__k" in ln for ln in above), above


def test_erp_lines_of_orders_with_null_and_repeated_ids(spark):
    from pyspark.sql import Window, functions as F
    from tallywise.plans.flatten import erp_order_lines
    from tallywise.sources.nested import erp_landing
    t = erp_landing(spark, SMALL)
    heads = t["erp_orders"].limit(4).withColumn("n", F.row_number().over(Window.orderBy("id")))
    heads = heads.withColumn("id", F.when(F.col("n") == 1, None).when(F.col("n") == 2, 7).when(F.col("n") == 3, 7).otherwise(8).cast("bigint")).drop("n")
    lines = t["erp_order_lines"].limit(4).withColumn("n", F.row_number().over(Window.orderBy("id")))
    lines = lines.withColumn("order_id", F.when(F.col("n") == 1, None).when(F.col("n") < 4, 7).otherwise(9).cast("bigint")).drop("n")
    got = erp_order_lines(heads, lines, t["erp_products"], t["erp_partners"], t["erp_states"], t["erp_countries"])
    rows = sorted(((r["odoo_id"] or 0, r["line_number"], r["product_unit_price"] is None) for r in got.collect()))
    assert rows == [(0, 1, True), (7, 1, False), (7, 1, False), (7, 2, False), (7, 2, False), (8, 1, True)]
