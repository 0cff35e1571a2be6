"""Nested landing data built in Spark from the driver's tables.

These stand in for the storefront's API payloads: bulk-export JSON lines,
catalogue pages and order documents. Each builder is a plain Spark job over
the tables, so the payload grows with them; groups are bounded by the payload
shape (lines per order, variants per product, products per page).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywise.sources.fixtures import FAMILY, SIZE_CASE, fixtures

_SKU = f"{FAMILY.format(k='p_partkey')} || '-' || {SIZE_CASE.format(k='p_partkey')}"
_IQ = "cast(case when p_partkey % 8 = 0 then 0 else p_size end as double)"
_PRODUCT_GID = "'gid://shopify/Product/' || cast(p_partkey as string)"
_VARIANT_GID = "'gid://shopify/ProductVariant/' || cast(p_partkey as string)"

# Record layout of the bulk export (one JSON object per line, three kinds).
BULK_LINES_SQL = f"""
select value, line_no from (
  select case when p_partkey % 23 = 0
              then to_json(named_struct('id', {_PRODUCT_GID}, 'title', p_name,
                                        'handle', lower(replace(p_name, ' ', '-'))))
              else to_json(named_struct('id', {_PRODUCT_GID}, 'title', p_name,
                                        'handle', lower(replace(p_name, ' ', '-')),
                                        'status', case when p_partkey % 11 = 0 then 'ARCHIVED' else 'ACTIVE' end))
         end as value,
         p_partkey * 10 as line_no
  from part where p_partkey % 29 <> 0
  union all
  select to_json(named_struct('id', {_VARIANT_GID}, '__parentId', {_PRODUCT_GID},
                              'sku', case when p_partkey % 13 = 0 then cast(null as string) else {_SKU} end,
                              'title', {SIZE_CASE.format(k='p_partkey')},
                              'inventoryQuantity', {_IQ}),
                 map('ignoreNullFields', 'false')) as value,
         p_partkey * 10 + 1 as line_no
  from part
  union all
  select to_json(named_struct('id', {_VARIANT_GID}, '__parentId', {_PRODUCT_GID},
                              'sku', {_SKU}, 'title', {SIZE_CASE.format(k='p_partkey')},
                              'inventoryQuantity', {_IQ} + 100)) as value,
         p_partkey * 10 + 5 as line_no
  from part where p_partkey % 9 = 0 and p_partkey % 13 <> 0
  union all
  select /*+ merge(s) */ to_json(named_struct('__parentId', {_VARIANT_GID}, 'location', named_struct('name', 'Main'),
                              'quantities', array(named_struct('name', 'available', 'quantity', s.available),
                                                  named_struct('name', 'on_hand', 'quantity', s.on_hand),
                                                  named_struct('name', 'committed', 'quantity', s.committed),
                                                  named_struct('name', 'incoming', 'quantity', s.incoming)))) as value,
         p_partkey * 10 + 2 as line_no
  from part join storefront_inventory s on s.sku = {_SKU}
  union all
  select to_json(named_struct('__parentId', {_VARIANT_GID}, 'location', named_struct('name', 'Annex'),
                              'quantities', array(named_struct('name', 'available', 'quantity', 1.0D),
                                                  named_struct('name', 'on_hand', 'quantity', 2.0D),
                                                  named_struct('name', 'on_hand', 'quantity', 3.0D),
                                                  named_struct('name', 'reserved', 'quantity', 7.0D)))) as value,
         p_partkey * 10 + 3 as line_no
  from part where p_partkey % 7 <> 0 and p_partkey % 3 = 0
  union all
  select to_json(named_struct('note', 'export footer', '__parentId', '')) as value, p_partkey * 10 + 4 as line_no
  from part where p_partkey % 50 = 0
)
"""

# Catalogue pages: pages -> products (plant families) -> variant edges.
CATALOG_PAGES_SQL = f"""
with v as (
  select cast(floor(p_partkey / 4) as bigint) as fam, p_name,
         named_struct('node', named_struct(
             'id', {_VARIANT_GID},
             'sku', case when p_partkey % 19 = 0 then '' else {_SKU} end,
             'title', {SIZE_CASE.format(k='p_partkey')},
             'inventoryQuantity', {_IQ},
             'inventoryItem', named_struct('inventoryLevel',
                 case when p_partkey % 6 = 0 then named_struct('quantity', {_IQ} + 1) end))) as edge
  from part),
p as (
  select fam, named_struct('node', named_struct(
             'id', 'gid://shopify/Product/' || cast(fam as string),
             'title', min(p_name),
             'handle', 'fam-' || cast(fam as string),
             'status', case when fam % 11 = 0 then 'ARCHIVED' else 'ACTIVE' end,
             'variants', named_struct('edges', array_sort(collect_list(edge))))) as product
  from v group by fam)
select cast(floor(fam / 50) as bigint) as page_no,
       to_json(named_struct('data', named_struct('products', named_struct(
           'edges', array_sort(collect_list(product)))))) as body
from p group by cast(floor(fam / 50) as bigint)
"""


def bulk_export_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk-export JSON lines ``(value, line_no)``; ``line_no`` is file order."""
    fixtures(spark, sf_dir)
    return spark.sql(BULK_LINES_SQL)


def catalog_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue API pages ``(page_no, body)`` with nested product edges."""
    fixtures(spark, sf_dir)
    return spark.sql(CATALOG_PAGES_SQL)

# Storefront order documents: one nested record per order, lines sorted by
# position; orders without lines carry a null line array. The lines are gathered by a window, which
# keeps the order of the line numbers' sort; an aggregate that collects sorts the finished lines again, twice.
ORDER_DOCS_SQL = """
with li as (
  select l_orderkey, array_sort(items) as line_items
  from (select l_orderkey, nth, collect_list(item) over (partition by l_orderkey) as items
  from (select b.l_orderkey, b.nth, named_struct(
             'line_no', b.line_no, 'sku', b.sku, 'name', b.p_name || ' - ' || b.size_code,
             'quantity', b.l_quantity, 'price', cast(b.l_extendedprice as string),
             'vendor', case when b.m % 4 <> 0 then 'V' || cast(b.m as string) end,
             'requires_shipping', b.m % 2 = 0, 'taxable', b.m % 3 <> 0,
             'fulfillment_status', case when b.m % 2 = 0 then 'fulfilled' end,
             'variant', case when b.m % 3 <> 0 then named_struct('compare_at_price', cast(b.m as string) || '.25') end,
             'discount_allocations', case b.m % 5 when 0 then null when 1 then array()
                 else array(named_struct('amount', '1.25'), named_struct('amount', cast(b.m as string) || '.5')) end,
             'tax_lines', case b.m % 3 when 0 then null
                 when 1 then array(named_struct('title', 'VAT', 'price', cast(b.m as string) || '.75'))
                 else array(named_struct('title', 'VAT', 'price', '0.75'), named_struct('title', 'Levy', 'price', '1.50')) end
             ) as item
  from (select l.*, p.p_name, row_number() over (partition by l.l_orderkey order by l.line_no) as nth
        from base_lines l join part p on p.p_partkey = l.l_partkey) b))
  where nth = 1)
select o.o_orderkey as id,
       '#' || cast(o.o_orderkey as string) as name,
       case when o.o_orderkey % 4 = 0 then null
            else lower(replace(c.c_name, '#', '.')) || '@example.com' end as email,
       case o.o_orderstatus when 'F' then 'paid' when 'O' then 'pending' else 'partially_paid' end as financial_status,
       cast(cast(o.o_orderdate as date) as string) as processed_at,
       cast(cast(o.o_orderdate as date) as string) || 'T08:00:00-04:00' as created_at,
       case when o.o_orderstatus = 'F' then 'fulfilled' end as fulfillment_status,
       o.o_orderkey % 2 = 0 as buyer_accepts_marketing,
       case when o.o_orderkey % 2 = 1 then '555-' || cast(o.o_orderkey as string) end as phone,
       case when o.o_orderkey % 9 = 0 then cast(cast(o.o_orderdate as date) as string) || 'T20:00:00Z' end as cancelled_at,
       case when o.o_orderkey % 3 = 0 then 'CAD' else 'USD' end as currency,
       cast(o.o_orderkey % 97 as string) || '.50' as subtotal_price,
       cast(o.o_orderkey % 13 as string) || '.10' as total_tax,
       cast(o.o_orderkey % 997 as string) || '.99' as total_price,
       cast(o.o_orderkey % 7 as string) || '.00' as total_discounts,
       case when o.o_orderkey % 8 = 0 then '1.00' end as total_duties,
       case when o.o_orderkey % 6 <> 0 then 'note ' || cast(o.o_orderkey as string) end as note,
       case when o.o_orderkey % 3 = 0 then '' else 'a, b' end as tags,
       case when o.o_orderkey % 4 <> 0 then 'pos' end as source_name,
       case o.o_orderkey % 3 when 0 then null when 1 then '' else 'ck' || cast(o.o_orderkey as string) end as checkout_token,
       case when o.o_orderkey % 2 = 0 then 'ct' || cast(o.o_orderkey as string) end as cart_token,
       o.o_orderkey + 1000 as checkout_id,
       case when o.o_orderkey % 4 <> 1
            then named_struct('shop_money', named_struct('amount', cast(o.o_orderkey % 11 as string) || '.00'))
            end as total_shipping_price_set,
       case o.o_orderkey % 3 when 0 then array()
            when 1 then array(named_struct('code', 'SAVE' || cast(o.o_orderkey as string)))
            else array(named_struct('code', 'A'), named_struct('code', cast(null as string))) end as discount_codes,
       case when o.o_orderkey % 5 <> 0
            then array(named_struct('title', case when o.o_orderkey % 2 = 0 then 'Ground' else 'Air' end),
                       named_struct('title', 'Spare')) end as shipping_lines,
       case o.o_orderkey % 4 when 0 then array() when 1 then null
            else array(named_struct('created_at', cast(cast(o.o_orderdate as date) as string) || 'T10:00:00Z')) end as fulfillments,
       case when o.o_orderkey % 3 = 0 then array()
            else array(named_struct('name', 'gift', 'value', cast(o.o_orderkey % 2 as string))) end as note_attributes,
       case o.o_orderkey % 5 when 0 then null when 1 then array() else array('card', 'gift') end as payment_gateway_names,
       case when o.o_orderkey % 7 = 0
            then named_struct('payment_terms_name', 'Net 30',
                              'next_payment_due_at', cast(cast(o.o_orderdate as date) as string)) end as payment_terms,
       case when o.o_orderkey % 5 = 0 then null
            else array(named_struct('kind', case when o.o_orderkey % 5 < 3 then 'refund' end,
                                    'transactions', array(named_struct('kind', 'refund', 'amount', cast(2 as double)),
                                                          named_struct('kind', 'sale', 'amount', cast(5 as double)))),
                       named_struct('kind', 'void',
                                    'transactions', array(named_struct('kind', 'refund', 'amount', cast(9 as double)))))
            end as refunds,
       case when o.o_orderkey % 5 <> 0
            then named_struct('first_name', c.c_name, 'last_name', c.c_mktsegment,
                              'address1', cast(o.o_orderkey as string) || ' Main',
                              'address2', case when o.o_orderkey % 2 = 0 then 'Unit 2' end,
                              'company', c.c_mktsegment, 'city', 'City ' || cast(o.o_orderkey % 10 as string),
                              'zip', cast(10000 + o.o_orderkey % 100 as string),
                              'province', case when o.o_orderkey % 4 <> 0 then 'Ontario' end, 'province_code', 'ON',
                              'country_code', 'CA', 'phone', '1-' || cast(o.o_orderkey as string)) end as billing_address,
       case when o.o_orderkey % 7 <> 0
            then named_struct('first_name', c.c_name, 'last_name', cast(null as string),
                              'address1', cast(o.o_orderkey as string) || ' Dock', 'address2', cast(null as string),
                              'company', cast(null as string), 'city', 'Port ' || cast(o.o_orderkey % 10 as string),
                              'zip', cast(20000 + o.o_orderkey % 100 as string), 'province', 'Ohio',
                              'province_code', 'OH', 'country_code', 'US',
                              'phone', cast(null as string)) end as shipping_address,
       case when o.o_orderkey % 3 = 0 then named_struct('level', lower(o.o_orderpriority)) end as order_risk,
       li.line_items
from orders o join customer c on c.c_custkey = o.o_custkey
left join li on li.l_orderkey = o.o_orderkey
"""

# Line-level nested arrays (taxes, discounts, refunds) on each base line.
LINE_ARRAYS_SQL = """
select l_orderkey, line_no,
       case when m % 3 = 0 then array()
            when m % 3 = 1 then array(named_struct('code', 'SAVE' || cast(m as string)))
            else array(named_struct('code', 'A'), named_struct('code', cast(null as string))) end as discount_codes,
       case when m % 2 = 0
            then array(named_struct('title', 'VAT', 'price', l_extendedprice * cast(0.1 as double)),
                       named_struct('title', 'Levy', 'price', cast(1.5 as double)))
            else array(named_struct('title', 'VAT', 'price', l_extendedprice * cast(0.1 as double))) end as tax_lines,
       case when m % 5 = 0 then null
            else array(named_struct('amount', l_quantity * cast(0.25 as double)),
                       named_struct('amount', cast(0.5 as double))) end as discount_allocations,
       array(named_struct('kind', case when m % 4 = 0 then 'refund' else 'void' end,
                          'transactions', array(named_struct('kind', 'refund', 'amount', cast(2 as double)),
                                                named_struct('kind', 'sale', 'amount', cast(5 as double)))),
             named_struct('kind', 'refund',
                          'transactions', array(named_struct('kind', case when m % 2 = 0 then 'refund' else 'sale' end,
                                                             'amount', l_quantity)))) as refunds
from base_lines
"""


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixtures(spark, sf_dir)
    return spark.sql(ORDER_DOCS_SQL)


def line_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixtures(spark, sf_dir)
    return spark.sql(LINE_ARRAYS_SQL)


# ERP landing tables: order headers, order lines, products, partners,
# states and countries, as the ERP's read calls return them.
ERP_SQL = {
    "erp_orders": """
select o_orderkey as id, 'SO' || cast(o_orderkey as string) as name, o_custkey as partner_id,
       cast(o_orderdate as string) as date_order,
       case o_orderstatus when 'F' then 'sale' when 'O' then 'draft' else 'sent' end as state,
       case when o_orderkey % 10 = 0 then null else '#' || cast(o_orderkey as string) end as client_order_ref,
       case o_orderkey % 3 when 1 then 'pending' when 2 then 'full' end as delivery_status,
       case when o_orderkey % 3 = 0 then 'CAD' else 'USD' end as currency,
       o_totalprice * cast(0.75 as double) as amount_untaxed, o_totalprice * cast(0.25 as double) as amount_tax,
       o_totalprice as amount_total, o_orderpriority as invoice_status,
       case when o_orderkey % 6 <> 0 then 'note ' || cast(o_orderkey as string) end as note,
       o_custkey as partner_invoice_id,
       case when o_orderkey % 4 = 0 then null else o_custkey + o_orderkey % 3 end as partner_shipping_id
from orders""",
    "erp_order_lines": """
select l_orderkey * 100 + line_no as id, l_orderkey as order_id,
       case when m = 9 then null else l_partkey end as product_id,
       l_quantity as product_uom_qty, case when m % 4 = 0 then 'Dozen' else 'Units' end as product_uom,
       l_extendedprice as price_unit, l_quantity * l_extendedprice as price_subtotal,
       l_extendedprice * cast(0.125 as double) as price_tax, l_extendedprice * cast(1.125 as double) as price_total,
       line_no as sequence
from base_lines""",
    "erp_products": """
select p_partkey as id, p_name as name, 'FAM-' || cast(cast(floor(p_partkey / 4) as bigint) as string) || '-' ||
       case p_partkey % 4 when 0 then '01G' when 1 then '03G' when 2 then '07G' else '15G' end as default_code,
       p_type as description_sale
from part""",
    "erp_partners": """
select c_custkey as id, c_name as name,
       case when c_custkey % 4 <> 0 then 'p' || cast(c_custkey as string) || '@example.com' end as email,
       case when c_custkey % 3 <> 0 then '555-' || cast(c_custkey as string) end as phone,
       c_mktsegment as street, case when c_custkey % 2 = 0 then 'Unit ' || cast(c_custkey as string) end as street2,
       'City ' || cast(c_custkey % 10 as string) as city, cast(10000 + c_custkey % 100 as string) as zip,
       c_nationkey as country_id,
       n.n_regionkey as state_id
from customer join nation n on n.n_nationkey = c_nationkey""",
    "erp_states": "select r_regionkey as id, r_name as name from region",
    "erp_countries": "select n_nationkey as id, n_name as name from nation",
}


def erp_landing(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    fixtures(spark, sf_dir)
    return {k: spark.sql(v) for k, v in ERP_SQL.items()}
