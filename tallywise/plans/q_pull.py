"""Registered pull-sheet queries."""

from __future__ import annotations

from tallywise.plans import pull as P
from tallywise.plans.registry import query
from tallywise.sources.fixtures import fixtures, paired_quants, with_clause
from tallywise.sources.sinks import ranked


@query("pullsheet", with_clause("picking") + r"""
select split_part(order_text, '/', 1) as ord,
       trim(regexp_replace(cast(item as varchar), '\[.*?\]', '', 'g')) as item,
       replace(cast(location as varchar), 'F/Stock/', '') as location,
       quantity as qty, on_hand
from picking where quantity > 0""")
def q_pullsheet(spark, sf_dir):
    return P.pullsheet(fixtures(spark, sf_dir).picking)


@query("order_targets", with_clause("picking") + """
select regexp_extract(order_text, '^[^/]*') as ord, count(*)::bigint as skus, sum(quantity) as plants
from picking where quantity > 0 and order_text is not null group by 1""")
def q_order_targets(spark, sf_dir):
    return P.order_targets(fixtures(spark, sf_dir).picking)


@query("alt_stock", with_clause("quants", "picking") + """
select distinct q.product_label as product_id, q.location_label as location_id, ifnull(q.quantity, 0) as quantity
from quants q
where starts_with(q.location_label, 'F')
  and exists (from picking where picking.item = q.product_label and picking.location <> q.location_label)""")
def q_alt_stock(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return P.alternative_stock(P.stock_levels(paired_quants(fx.quants)), fx.picking)


_PULLED = """
, pulled AS (
select split_part(order_text, '/', 1) as ord, trim(regexp_replace(item, '\\[.*?\\]', '', 'g')) as item,
       replace(location, 'F/Stock/', '') as location, quantity as qty, on_hand
from picking where quantity > 0)
"""


@query("report_pullsheet", with_clause("picking") + _PULLED + """
select *, row_number() over (order by location nulls first, item nulls first, ord nulls first, qty, on_hand nulls first) as rank from pulled""")
def q_report_pullsheet(spark, sf_dir):
    return ranked(P.pullsheet(fixtures(spark, sf_dir).picking), P.PULLSHEET_ORDER)


@query("report_order_targets", with_clause("picking") + _PULLED + """
select *, row_number() over (order by ord) as rank
from (select ord, count(*) as skus, sum(qty) as plants from pulled group by ord)""")
def q_report_order_targets(spark, sf_dir):
    return ranked(P.order_targets(fixtures(spark, sf_dir).picking), P.TARGETS_ORDER)


@query("report_alt_stock", with_clause("quants", "picking") + """
select *, row_number() over (order by product_id, location_id, quantity) as rank
from (select distinct product_label as product_id, location_label as location_id, ifnull(quantity, 0) as quantity
      from quants where location_label like 'F%'
        and exists (from picking where picking.item = product_label and picking.location <> location_label))""")
def q_report_alt_stock(spark, sf_dir):
    return ranked(q_alt_stock(spark, sf_dir), P.ALT_STOCK_ORDER)


@query("pullsheet_file", with_clause("picking") + _PULLED + "select * from pulled")
def q_pullsheet_file(spark, sf_dir):
    """The transfer sheet landed as a header CSV with the ERP's own headers and a further column."""
    import uuid

    from pyspark.sql import functions as F
    from tallywise.constants import PICKING_RENAME
    from tallywise.session import scratch_path
    from tallywise.sources.files import write_csv
    path = scratch_path(spark, f"tallywise/transfer/{uuid.uuid4().hex}")
    picking = fixtures(spark, sf_dir).picking
    write_csv(picking.select(F.lit('said "soon",\nor later').alias("Note"), *[F.col(c).alias(h) for h, c in PICKING_RENAME.items()]), path)
    return P.pullsheet(P.read_picking(spark, path))
