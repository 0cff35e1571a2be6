"""Landing views derived from the driver's tables.

The flat views below are fixed texts: the same string runs in Spark SQL and
in DuckDB, so the oracle queries can inline them as CTEs. Nested landing data
(storefront order documents, bulk-export JSON lines, catalogue pages) is built
in Spark from the flat views by the functions at the end of this module.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.sources.tables import register_tables

# ---------------------------------------------------------------------------
# The flat landing views, text shared by Spark and the oracle.
# ---------------------------------------------------------------------------
SIZE_CASE = ("case {k} % 4 when 0 then '01G' when 1 then '03G' "
             "when 2 then '07G' else '15G' end")
FAMILY = "'FAM-' || cast(cast(floor({k} / 4) as bigint) as string)"

VIEWS: dict[str, str] = {}
VIEW_DEPS: dict[str, tuple[str, ...]] = {}


def _view(name: str, deps: tuple[str, ...], sql: str) -> None:
    VIEWS[name] = sql.strip()
    VIEW_DEPS[name] = deps


_view("base_lines", (), f"""
select l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
       l.l_returnflag, l.l_linestatus, l.l_shipdate,
       (l.l_orderkey * 7 + l.l_linenumber) % 20 as m,
       {FAMILY.format(k='l.l_partkey')} as prefix,
       {SIZE_CASE.format(k='l.l_partkey')} as size_code,
       {FAMILY.format(k='l.l_partkey')} || '-' ||
       {SIZE_CASE.format(k='l.l_partkey')} as sku,
       cast(row_number() over (partition by l.l_orderkey
            order by l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice) as bigint) as line_no
from lineitem l
""")

_STOREFRONT_COLUMNS = """
select case when b.m = 6 then null else '#' || cast(b.l_orderkey as string) end as order_name,
       b.sku, p.p_name || ' - ' || b.size_code as product_name,
       case when b.m = 7 then 'n/a' else cast(b.l_quantity as string) end as quantity,
       cast(b.l_extendedprice as string) as price,
       case o.o_orderstatus when 'F' then 'paid' when 'O' then 'pending' else 'partially_paid' end as financial_status,
       o.o_orderdate as paid_at, c.c_name as billing_name, b.line_no, b.l_orderkey,
       case when o.o_orderkey % 4 > 0 then 'buyer' || cast(o.o_custkey as string) || '@example.com' end as email,
       case o.o_orderstatus when 'F' then 'fulfilled' when 'P' then 'partial' end as fulfillment_status,
       o.o_orderdate - interval '1' day as created_at,
       case when o.o_orderstatus = 'F' then o.o_orderdate + interval '2' day end as fulfilled_at,
       o.o_totalprice as total,
       case when o.o_orderkey % 3 > 0 then 'tag' || cast(o.o_orderkey % 5 as string) || ', web' else '' end as tags
"""
_view("storefront_lines", ("base_lines",), _STOREFRONT_COLUMNS + """from base_lines b
join orders o on o.o_orderkey = b.l_orderkey
join customer c on c.c_custkey = o.o_custkey
join part p on p.p_partkey = b.l_partkey
where b.m <> 1
""")

_view("erp_lines", ("base_lines",), """
select case when m = 6 then null else '#' || cast(l_orderkey as string) end as order_ref,
       '#' || cast(l_orderkey as string) as erp_name,
       case when m = 5 then lower(sku) else sku end as sku,
       case when m = 7 then 'n/a' when m = 2 then cast(l_quantity + 1 as string)
            else cast(l_quantity as string) end as quantity,
       cast(case when m = 3 then l_extendedprice + 0.05 when m = 4 then l_extendedprice + 0.001
            else l_extendedprice end as string) as price,
       case l_linestatus when 'F' then 'full' else 'pending' end as delivery_status,
       'Plant ' || sku as product_name,
       case l_returnflag when 'R' then 'no' when 'A' then 'to invoice' else 'invoiced' end as payment_status,
       l_shipdate as order_date, l_extendedprice + 10 as total, l_orderkey + 100000 as odoo_id
from base_lines
where m <> 0
""")

_view("legacy_lookup", (), f"""
select {FAMILY.format(k='p_partkey')} || '-' ||
       {SIZE_CASE.format(k='p_partkey')} as legacy_sku,
       case when p_partkey % 10 = 0 then null
            else 'BASE-' || cast(cast(floor(p_partkey / 4) as bigint) as string) end as base_sku
from part where p_partkey % 5 = 0
""")

_view("quants", ("base_lines",), """
select '[' || b.sku || '] ' || p.p_name as product_label,
       case when b.l_suppkey % 5 = 4 then 'W/Other/S' else 'F/Stock/S' end || cast(b.l_suppkey % 5 as string) as location_label,
       b.l_partkey,
       case when (b.l_partkey + b.l_suppkey % 5) % 6 = 0 then cast(0 as double) else min(b.l_quantity) end as quantity,
       case when (b.l_partkey + b.l_suppkey % 5) % 6 = 0 then cast(0 as double)
            else min(b.l_quantity) - cast(b.l_partkey % 3 as double) end as available_quantity,
       case when b.l_partkey % 13 = 0 then 'lot' else 'none' end as tracking,
       case when b.l_partkey % 17 = 0 then 'Pot' else 'Plant' end as category
from base_lines b join part p on p.p_partkey = b.l_partkey
group by b.sku, p.p_name, b.l_partkey, b.l_suppkey % 5
""")

_view("sizes", (), """
select * from (values ('01G', 1.0E0), ('03G', 3.0E0), ('07G', 7.0E0)) as t(name, container_capacity)
""")

_view("storefront_products", (), f"""
select {FAMILY.format(k='p_partkey')} || '-' ||
       {SIZE_CASE.format(k='p_partkey')} as sku,
       p_name as title,
       {SIZE_CASE.format(k='p_partkey')} as option1,
       cast(case when p_partkey % 8 = 0 then 0 else p_size end as double) as inventory_quantity,
       cast(p_size + p_partkey % 3 as double) as old_inventory_quantity,
       case when p_partkey % 11 = 0 then 'archived' else 'active' end as status
from part
""")

_view("storefront_inventory", (), f"""
select {FAMILY.format(k='p_partkey')} || '-' ||
       {SIZE_CASE.format(k='p_partkey')} as sku,
       p_name as title,
       {SIZE_CASE.format(k='p_partkey')} as option_value,
       cast(case when p_partkey % 8 = 0 then 0 else p_size end as double) as on_hand,
       cast(case when p_partkey % 8 = 0 then 0 else p_size - p_partkey % 4 end as double) as available,
       cast(p_partkey % 4 as double) as committed,
       cast(p_partkey % 2 as double) as unavailable,
       cast(p_partkey % 5 as double) as incoming
from part where p_partkey % 7 <> 0
""")

_view("inventory_csv", ("storefront_inventory",), f"""
select s.sku, case when n.i = 0 then null else s.title || ' v' || cast(n.i as string) end as title,
       s.option_value,
       case when (p.p_partkey + n.i) % 9 = 0 then 'not stocked' else cast(s.available + n.i as string) end as available,
       case when (p.p_partkey + n.i) % 5 = 0 then 'x' else cast(s.on_hand + n.i as string) end as on_hand,
       cast(s.committed as string) as committed, cast(s.unavailable as string) as unavailable,
       cast(s.incoming as string) as incoming, p.p_partkey * 4 + n.i as row_idx
from storefront_inventory s
join part p on s.sku = {FAMILY.format(k='p.p_partkey')} || '-' ||
       {SIZE_CASE.format(k='p.p_partkey')}
cross join (select * from (values (0), (1), (2), (3)) as v(i)) n
""")

# Spark text for views whose portable text uses a construct Spark would plan
# badly at scale. inventory_csv replicates each inventory row for locations
# 0..3 with a cross join to a 4-row literal; in Spark the same rows come from
# exploding the four location indices (no join). Its join on SKU texts shuffles both sides: part's
# file size hides how large the texts are as a broadcast hash table.
# storefront_lines joins orders to their customers first, then the lines with their columns as they are: a line is not
# shuffled to meet its order's customer, and its texts are built after the joins, so they are not shuffled with it.
SPARK_TEXT: dict[str, str] = {
    "storefront_lines": re.sub(r"\b[ocp]\.", "b.", _STOREFRONT_COLUMNS).strip() + f"""
from (
select j.*, (j.l_orderkey * 7 + j.l_linenumber) % 20 as m, {SIZE_CASE.format(k='j.l_partkey')} as size_code,
       {FAMILY.format(k='j.l_partkey')} || '-' ||
       {SIZE_CASE.format(k='j.l_partkey')} as sku
from (
select l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.line_no, o.*, p.p_name
from (
select l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice,
       cast(row_number() over (partition by l_orderkey
            order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as bigint) as line_no
from lineitem) l
join (
select o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_totalprice, c_name
from orders join customer on c_custkey = o_custkey) o on o.o_orderkey = l.l_orderkey
join part p on p.p_partkey = l.l_partkey
where (l.l_orderkey * 7 + l.l_linenumber) % 20 <> 1) j) b
""".rstrip(),
    "inventory_csv": f"""
select /*+ merge(s) */ s.sku, case when n.i = 0 then null else s.title || ' v' || cast(n.i as string) end as title,
       s.option_value,
       case when (p.p_partkey + n.i) % 9 = 0 then 'not stocked' else cast(s.available + n.i as string) end as available,
       case when (p.p_partkey + n.i) % 5 = 0 then 'x' else cast(s.on_hand + n.i as string) end as on_hand,
       cast(s.committed as string) as committed, cast(s.unavailable as string) as unavailable,
       cast(s.incoming as string) as incoming, p.p_partkey * 4 + n.i as row_idx
from storefront_inventory s
join part p on s.sku = {FAMILY.format(k='p.p_partkey')} || '-' ||
       {SIZE_CASE.format(k='p.p_partkey')}
lateral view explode(array(0, 1, 2, 3)) n as i
""".strip(),
}


_view("picking", ("base_lines",), """
select case when b.line_no = 2 then 'SO' || cast(b.l_orderkey as string)
            else 'SO' || cast(b.l_orderkey as string) || '/' || cast(b.line_no as string) end as order_text,
       '[' || b.sku || '] ' || p.p_name as item,
       'F/Stock/S' || cast(b.l_suppkey % 5 as string) as location,
       case when b.line_no = 3 then cast(0 as double) else b.l_quantity end as quantity,
       cast(p.p_size as double) as on_hand
from base_lines b join part p on p.p_partkey = b.l_partkey
""")

_view("order_export", ("base_lines",), """
select '#' || cast(b.l_orderkey as string) as name,
       case when b.line_no = 1 then c.c_name end as billing_name,
       case when b.line_no = 1 then cast(cast(o.o_orderdate as date) as string) || ' 10:00:00' ||
            case when o.o_orderkey % 2 = 0 then ' -0500' else ' -0400' end end as paid_at,
       b.l_quantity as quantity, b.l_extendedprice as price,
       case when b.m = 8 then null else b.sku end as sku,
       case when b.line_no = 1 then n.n_name end as billing_country,
       b.l_orderkey, b.line_no
from base_lines b
join orders o on o.o_orderkey = b.l_orderkey
join customer c on c.c_custkey = o.o_custkey
join nation n on n.n_nationkey = c.c_nationkey
""")

_view("existing_orders", (), """
select '#' || cast(o_orderkey as string) as name from orders where o_orderkey % 3 = 0
""")

_view("existing_contacts", (), """
select c_name as name, case when c_custkey % 12 = 0 then 'invoice' else 'contact' end as type
from customer where c_custkey % 4 = 0
""")


def paired_quants(quants: DataFrame) -> DataFrame:
    """The stock read as the ERP gives it: the product as a pair of id and label."""
    return quants.withColumn("product", F.struct(F.col("l_partkey").alias("id"), F.col("product_label").alias("label")))


def _closure(names) -> list[str]:
    """Views needed for ``names``, dependencies first."""
    out: list[str] = []

    def visit(n: str) -> None:
        for d in VIEW_DEPS[n]:
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_clause(*names: str) -> str:
    """``WITH v1 AS (...), v2 AS (...)`` text for the oracle side."""
    parts = [f"{n} AS (\n{VIEWS[n]}\n)" for n in _closure(names)]
    return "WITH " + ",\n".join(parts) + "\n"


class Fixtures:
    """Flat landing views over one scale-factor folder, as Spark DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        register_tables(spark, sf_dir)
        for name in _closure(VIEWS):
            spark.sql(SPARK_TEXT.get(name, VIEWS[name])).createOrReplaceTempView(name)

    def view(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.spark.table(name)
        raise AttributeError(name)


_CACHE: dict[tuple[int, str], Fixtures] = {}


def fixtures(spark: SparkSession, sf_dir: str) -> Fixtures:
    """Register (once per session and folder) and return the fixture views."""
    key = (id(spark), sf_dir)
    fx = _CACHE.get(key)
    if fx is None or _CACHE.get(("last", "")) is not fx:
        fx = Fixtures(spark, sf_dir)
        _CACHE[key] = fx
        _CACHE[("last", "")] = fx
    return fx
