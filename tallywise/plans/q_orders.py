"""Registered order-flow queries."""

from __future__ import annotations


from tallywise.plans import orders as O
from tallywise.plans.registry import query
from tallywise.sources.fixtures import fixtures, with_clause
from tallywise.sources.sinks import ranked

COMPARED_AS_OF = "2026-01-01T00:00:00"

_CMP_SQL = """
shop AS (
select order_name as shopify_order_number, sku as shopify_sku, product_name as shopify_product_name,
       try_cast(quantity as double) as shopify_quantity, try_cast(price as double) as shopify_price,
       financial_status as shopify_financial_status, fulfillment_status as shopify_fulfillment_status,
       created_at as shopify_created_at, paid_at as shopify_paid_at, fulfilled_at as shopify_fulfilled_at, total as shopify_total
from storefront_lines),
erp AS (
select order_ref as odoo_shopify_order_number, sku as odoo_sku, product_name as odoo_product_name,
       try_cast(quantity as double) as odoo_quantity, try_cast(price as double) as odoo_price,
       payment_status as odoo_payment_status, delivery_status as odoo_delivery_status, order_date as odoo_order_date,
       total as odoo_total, erp_name as odoo_order_name, odoo_id as odoo_order_id
from erp_lines),
both_sides AS (
select *, shopify_quantity is not distinct from odoo_quantity as quantity_match,
       coalesce(abs(shopify_price - odoo_price) < 0.01, shopify_price is null and odoo_price is null) as price_match
from shop full join erp
  on lower(shopify_order_number) is not distinct from lower(odoo_shopify_order_number)
 and lower(shopify_sku) is not distinct from lower(odoo_sku)),
cmp AS (
select *, shopify_order_number is not null as in_shopify, odoo_shopify_order_number is not null as in_odoo,
       case when shopify_order_number is null then 'Missing in Shopify'
            when odoo_shopify_order_number is null then 'Missing in Odoo'
            when not quantity_match then 'Quantity mismatch'
            when not price_match then 'Price mismatch' else 'Synced' end as sync_status
from both_sides)
"""


def _cmp_with() -> str:
    return with_clause("storefront_lines", "erp_lines").rstrip() + ",\n" + _CMP_SQL


def comparison(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return O.compare_orders(fx.storefront_lines, fx.erp_lines)


@query("order_compare", _cmp_with() + f"select *, '{COMPARED_AS_OF}' as comparison_date from cmp")
def q_order_compare(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return O.compare_orders(fx.storefront_lines, fx.erp_lines, COMPARED_AS_OF)


@query("sync_status_counts", _cmp_with() +
       "select sync_status, cast(count(*) as bigint) as n_lines from cmp group by sync_status")
def q_sync_status_counts(spark, sf_dir):
    return O.sync_status_counts(comparison(spark, sf_dir))


@query("sync_report", _cmp_with() + """
select cast(coalesce(sum(case when sync_status = 'Missing in Odoo' then 1 else 0 end), 0) as bigint) as to_import,
       cast(coalesce(sum(case when sync_status in ('Quantity mismatch', 'Price mismatch') then 1 else 0 end), 0) as bigint) as to_update
from cmp""")
def q_sync_report(spark, sf_dir):
    return O.sync_report(comparison(spark, sf_dir))


_SAMPLE_COLS = ", ".join(O.SAMPLE_ORDER)
_SAMPLE_KEYS = ", ".join(f"{c} asc nulls first" for c in O.SAMPLE_ORDER)


@query("sync_report_samples", _cmp_with() + f"""
, acts AS (select case when sync_status = 'Missing in Odoo' then 'import'
                   when sync_status in ('Quantity mismatch', 'Price mismatch') then 'update' end as action,
              {_SAMPLE_COLS} from cmp)
select * from (select * from acts where action = 'import' order by {_SAMPLE_KEYS} limit 5)
union all
select * from (select * from acts where action = 'update' order by {_SAMPLE_KEYS} limit 5)""")
def q_sync_report_samples(spark, sf_dir):
    return O.sync_report_samples(comparison(spark, sf_dir), 5)


@query("paid_orders", with_clause("storefront_lines") +
       "select * from storefront_lines where financial_status = 'paid'")
def q_paid_orders(spark, sf_dir):
    return O.paid_orders(fixtures(spark, sf_dir).storefront_lines)


# The rule: a line whose SKU the lookup maps to a base gets the base's SKU, any other keeps its own.
_MAPPED = """
with_entry AS (
select l.* exclude (sku), coalesce(k.base_sku || '-01G', l.sku) as sku
from storefront_lines l join legacy_lookup k on k.legacy_sku = l.sku),
mapped AS (
select * from with_entry
union all by name
select * from storefront_lines l where not exists (from legacy_lookup k where k.legacy_sku = l.sku))
"""


@query("legacy_sku_map", with_clause("storefront_lines", "legacy_lookup").rstrip() + ",\n" + _MAPPED + """
select order_name, sku, email, financial_status, fulfillment_status, paid_at, quantity, product_name, price, billing_name, tags,
       strftime(paid_at, '%d') as day_paid, strftime(paid_at, '%m') as month_paid, strftime(paid_at, '%Y') as year_paid,
       case when product_name like '% - %' then trim(split_part(product_name, ' - ', 1)) else product_name end as plantname
from mapped""")
def q_legacy_sku_map(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return O.map_legacy_skus(fx.storefront_lines, fx.legacy_lookup)


_REPORT = with_clause("storefront_lines", "legacy_lookup", "erp_lines").rstrip() + ",\n" + _MAPPED + """,
sold AS (
select order_name as name, billing_name as customer, sku, product_name as item, paid_at as paid_date, quantity as qty,
       financial_status as payment, fulfillment_status as shipment, tags from mapped),
report AS (
select sold.*, e.delivery_status from sold join erp_lines e on e.erp_name = sold.name and e.sku = sold.sku
union all
select *, null from sold where not exists (from erp_lines e where e.erp_name = sold.name and e.sku = sold.sku))
"""


def _report(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return O.order_flow_report(O.map_legacy_skus(fx.storefront_lines, fx.legacy_lookup), fx.erp_lines)


@query("order_flow_report", _REPORT + "select * from report")
def q_order_flow_report(spark, sf_dir):
    return _report(spark, sf_dir)


@query("report_order_flow", _REPORT + """
select *, row_number() over (order by name desc nulls last, name, customer nulls first, sku nulls first, item nulls first,
  paid_date nulls first, qty nulls first, payment nulls first, shipment nulls first, delivery_status nulls first,
  tags nulls first) as rank from report""")
def q_report_order_flow(spark, sf_dir):
    """The report with its places: order name descending, as text."""
    return ranked(_report(spark, sf_dir), O.report_order())


LOOKBACK_AS_OF = "1998-08-02 00:00:00"
LOOKBACK_DAYS = 90  # the default look-back (constants.DEFAULT_LOOKBACK_DAYS)


@query("lookback_filter", f"""
select * from orders
where o_orderdate >= timestamp '{LOOKBACK_AS_OF}' - interval {LOOKBACK_DAYS} day""")
def q_lookback_filter(spark, sf_dir):
    from tallywise.functions import lookback
    fx = fixtures(spark, sf_dir)
    return fx.table("orders").filter(lookback("o_orderdate", LOOKBACK_AS_OF, LOOKBACK_DAYS))


@query("lookback_partitioned", f"""
select *, cast(date_trunc('month', o_orderdate) as date) as landed_day from orders
where o_orderdate >= timestamp '{LOOKBACK_AS_OF}' - interval {LOOKBACK_DAYS} day""")
def q_lookback_partitioned(spark, sf_dir):
    """Orders landed in time, by month here (the fixture has few orders a day); the window's folders alone are read."""
    import uuid

    from tallywise.session import scratch_path
    from tallywise.sources.landing import land_by_day, read_window
    path = scratch_path(spark, f"tallywise/landed_orders/{uuid.uuid4().hex}")
    land_by_day(fixtures(spark, sf_dir).table("orders"), "o_orderdate", path, grain="month")
    return read_window(spark, path, "o_orderdate", LOOKBACK_AS_OF, LOOKBACK_DAYS, grain="month")


@query("latest_order", with_clause("storefront_lines") + r"""
select created_at,
       coalesce(try_cast(regexp_extract(substr(order_name, 2), '^\s*([+-]?\d+)', 1) as bigint), 0) as order_num
from storefront_lines where order_name like '#%'
order by order_num desc, created_at asc nulls first limit 1""")
def q_latest_order(spark, sf_dir):
    return O.latest_order(fixtures(spark, sf_dir).storefront_lines)


@query("paid_date_parts", with_clause("order_export") + """
, p AS (select name, l_orderkey, line_no,
               strptime(substr(paid_at, 1, 19), '%Y-%m-%d %H:%M:%S')
               - to_minutes(cast((case substr(paid_at, 21, 1) when '-' then -1 else 1 end)
                 * (cast(substr(paid_at, 22, 2) as integer) * 60 + cast(substr(paid_at, 24, 2) as integer)) as bigint)) as utc
        from order_export)
select name, l_orderkey, line_no,
       strftime(utc, '%Y-%m-%dT%H:%M:%S') || '+0000' as paid_at,
       coalesce(strftime(utc, '%d'), '00') as day_paid,
       coalesce(strftime(utc, '%m'), '00') as month_paid,
       coalesce(cast(year(utc) as varchar), '0') as year_paid
from p""")
def q_paid_date_parts(spark, sf_dir):
    return O.paid_date_parts(fixtures(spark, sf_dir).order_export, keep=("name", "l_orderkey", "line_no"))


@query("plant_name", with_clause("storefront_lines") + """
select order_name, sku, line_no, l_orderkey, product_name,
       case when coalesce(product_name, '') like '% - %' then trim(split_part(product_name, ' - ', 1))
            else coalesce(product_name, '') end as plantname
from storefront_lines""")
def q_plant_name(spark, sf_dir):
    return O.with_plant_name(fixtures(spark, sf_dir).storefront_lines,
                             keep=("order_name", "sku", "line_no", "l_orderkey", "product_name"))
