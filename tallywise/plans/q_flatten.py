"""Registered nested-flatten and ERP-assembly queries."""

from __future__ import annotations

from tallywise.operators import number_within_group
from tallywise.plans import flatten as FL
from tallywise.plans.registry import query
from tallywise.sources.fixtures import fixtures, with_clause
from tallywise.sources.nested import ERP_SQL, erp_landing, line_arrays, order_documents


_FLATTEN_SQL = with_clause("base_lines") + """
, sold AS (
  select b.l_orderkey as k, b.l_quantity as lineitem_quantity, p.p_name || ' - ' || b.size_code as lineitem_name,
         cast(b.l_extendedprice as string) as lineitem_price, b.sku as lineitem_sku, b.m % 2 = 0 as lineitem_requires_shipping,
         b.m % 3 > 0 as lineitem_taxable, if(b.m % 2 = 0, 'fulfilled', null) as lineitem_fulfillment_status,
         if(b.m % 3 > 0, b.m || '.25', null) as lineitem_compare_at_price, if(b.m % 4 > 0, 'V' || b.m, null) as vendor,
         if(b.m % 5 < 2, cast(0 as double), 1.75 + cast(b.m as double)) as lineitem_discount,
         if(b.m % 3 > 0, 'VAT', null) as tax1_name,
         if(b.m % 3 = 1, b.m || '.75', if(b.m % 3 = 2, '0.75', null)) as tax1_value,
         if(b.m % 3 = 2, 'Levy', null) as tax2_name, if(b.m % 3 = 2, '1.50', null) as tax2_value,
         b.line_no as lineitem_number, p.p_name as before_size
  from base_lines b join part p on p.p_partkey = b.l_partkey),
bought AS (
  select o.o_orderkey as k, cast(cast(o.o_orderdate as date) as string) as day, o.o_orderstatus as st,
         lower(o.o_orderpriority) as risk, c.c_name as who, c.c_mktsegment as segment,
         o.o_orderkey % 5 > 0 as bills, o.o_orderkey % 7 > 0 as ships
  from orders o join customer c on c.c_custkey = o.o_custkey)
select '#' || k as name, if(k % 4 = 0, null, lower(replace(who, '#', '.')) || '@example.com') as email,
       case st when 'F' then 'paid' when 'O' then 'pending' else 'partially_paid' end as financial_status,
       day as paid_at, if(st = 'F', 'fulfilled', 'unfulfilled') as fulfillment_status,
       if(k % 4 > 1, day || 'T10:00:00Z', null) as fulfilled_at, if(k % 2 = 0, 'yes', 'no') as accepts_marketing,
       if(k % 3 = 0, 'CAD', 'USD') as currency, (k % 97) || '.50' as subtotal,
       if(k % 4 = 1, null, (k % 11) || '.00') as shipping, (k % 13) || '.10' as taxes, (k % 997) || '.99' as total,
       if(k % 3 = 0, '', if(k % 3 = 1, 'SAVE' || k, 'A, ')) as discount_code, (k % 7) || '.00' as discount_amount,
       if(k % 5 = 0, null, if(k % 2 = 0, 'Ground', 'Air')) as shipping_method, day || 'T08:00:00-04:00' as created_at,
       if(bills, trim(who || ' ' || segment), '') as billing_name,
       if(bills, k || ' Main', null) as billing_street, if(bills, k || ' Main', null) as billing_address1,
       if(bills and k % 2 = 0, 'Unit 2', null) as billing_address2, if(bills, segment, null) as billing_company,
       if(bills, 'City ' || (k % 10), null) as billing_city, if(bills, cast(10000 + k % 100 as varchar), null) as billing_zip,
       if(bills, 'ON', null) as billing_province, if(bills, 'CA', null) as billing_country,
       if(bills, '1-' || k, null) as billing_phone, if(bills and k % 4 > 0, 'Ontario', 'Unknown') as billing_province_name,
       if(ships, trim(who), '') as shipping_name,
       if(ships, k || ' Dock', null) as shipping_street, if(ships, k || ' Dock', null) as shipping_address1,
       cast(null as varchar) as shipping_address2, cast(null as varchar) as shipping_company,
       if(ships, 'Port ' || (k % 10), null) as shipping_city, if(ships, cast(20000 + k % 100 as varchar), null) as shipping_zip,
       if(ships, 'OH', null) as shipping_province, if(ships, 'US', null) as shipping_country,
       cast(null as varchar) as shipping_phone, if(ships, 'Ohio', 'Unknown') as shipping_province_name,
       if(k % 6 = 0, null, 'note ' || k) as notes,
       if(k % 3 = 0, '[]', '[{"name":"gift","value":"' || (k % 2) || '"}]') as note_attributes,
       if(k % 9 = 0, day || 'T20:00:00Z', null) as cancelled_at, if(k % 5 < 2, 'Unknown', 'card') as payment_method,
       if(k % 3 = 2, 'ck' || k, if(k % 2 = 0, 'ct' || k, null)) as payment_reference,
       cast(if(k % 5 in (1, 2), 7, 0) as double) as refunded_amount, if(k % 3 = 0, '', 'a, b') as tags,
       if(k % 3 = 0, risk, 'Unknown') as risk_level, k as shopify_id, if(k % 4 = 0, 'web', 'pos') as source,
       if(k % 2 = 1, '555-' || k, '') as phone, if(k % 8 = 0, '1.00', null) as duties, k + 1000 as payment_id,
       if(k % 7 = 0, 'Net 30', null) as payment_terms_name, if(k % 7 = 0, day, null) as next_payment_due_at,
       """ + ", ".join(f"cast(null as varchar) as {n}" for n in FL.ALWAYS_EMPTY) + """,
       sold.* exclude (k, lineitem_number, before_size), cast(coalesce(lineitem_number, 1) as bigint) as lineitem_number,
       if(lineitem_name is null, null, trim(split_part(before_size, ' - ', 1))) as plantname
from bought left join sold using (k)"""


@query("flatten_orders", _FLATTEN_SQL)
def q_flatten_orders(spark, sf_dir):
    from pyspark.sql import functions as F
    from tallywise.sources.schemas import parse_orders
    # The documents travel as JSON text and are parsed with the declared schema. The text passes as a
    # one-element array: merged into the parse, the expressions that build it would be interpreted, not compiled.
    docs = order_documents(spark, sf_dir)
    return FL.flatten_orders(parse_orders(docs.select(F.explode(F.array(F.to_json(F.struct(*docs.columns)))).alias("value"))))


@query("flatten_orders_file", _FLATTEN_SQL)
def q_flatten_orders_file(spark, sf_dir):
    """Order pages landed as JSON files (one document per line) and read
    with the declared order schema."""
    import uuid

    from tallywise.session import scratch_path
    from tallywise.sources.schemas import read_orders_json
    path = scratch_path(spark, f"tallywise/order_pages/{uuid.uuid4().hex}")
    order_documents(spark, sf_dir).write.option("compression", "gzip").json(path)
    return FL.flatten_orders(read_orders_json(spark, path))


@query("flatten_orders_rejects", """
select case when o_orderkey % 50 = 7 then 'reject' else 'order' end as kind, '#' || o_orderkey as name,
       case when o_orderkey % 50 = 7 then null else greatest(count(l_orderkey), 1) end as n_lines
from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey""")
def q_flatten_orders_rejects(spark, sf_dir):
    """Order documents of which every fiftieth lands cut off: the lines of the others per order, and the cut ones by name."""
    import uuid

    from pyspark.sql import functions as F
    from tallywise.session import scratch_path
    from tallywise.sources.rejects import read_documents
    from tallywise.sources.schemas import ORDER
    path = scratch_path(spark, f"tallywise/order_pages/{uuid.uuid4().hex}")
    docs = order_documents(spark, sf_dir)
    text = F.to_json(F.struct("name", *[c for c in docs.columns if c != "name"]))
    docs.select(F.when(F.col("id") % 50 == 7, F.substring(text, 1, 60)).otherwise(text).alias("value")).write.option("compression", "gzip").text(path)
    found = read_documents(spark, path, ORDER, keep_broken=True)
    lines = FL.flatten_orders(found.rows).groupBy("name").agg(F.count("*").alias("n_lines"))
    cut = found.rejects.select(F.lit("reject").alias("kind"), F.regexp_extract("value", '"name":"([^"]*)"', 1).alias("name"),
                               F.lit(None).cast("bigint").alias("n_lines"))
    return lines.select(F.lit("order").alias("kind"), "name", "n_lines").unionByName(cut)


@query("line_numbers", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
       cast(row_number() over (partition by l_orderkey
            order by l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as bigint) as line_no
from lineitem""")
def q_line_numbers(spark, sf_dir):
    li = fixtures(spark, sf_dir).table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    return number_within_group(li, "l_orderkey",
                               ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])


@query("array_ops", with_clause("base_lines") + """
select l_orderkey, line_no,
       case when m % 3 = 0 then '' when m % 3 = 1 then 'SAVE' || cast(m as string) else 'A, ' end as discount_code,
       'VAT' as tax1_name, l_extendedprice * cast(0.1 as double) as tax1_value,
       case when m % 2 = 0 then 'Levy' end as tax2_name,
       case when m % 2 = 0 then cast(1.5 as double) end as tax2_value,
       case when m % 5 = 0 then cast(0 as double)
            else (cast(0 as double) + l_quantity * cast(0.25 as double)) + cast(0.5 as double) end as lineitem_discount,
       cast(2 as double) + case when m % 2 = 0 then l_quantity else cast(0 as double) end as refunded_amount,
       case when m % 3 = 0 then '[]' when m % 3 = 1 then '["SAVE' || cast(m as string) || '"]'
            else '["A",null]' end as discount_codes_text
from base_lines""")
def q_array_ops(spark, sf_dir):
    return FL.line_array_fields(line_arrays(spark, sf_dir))


_ERP_WITH = with_clause("base_lines").rstrip() + ",\n" + ",\n".join(
    f"{k} AS ({v})" for k, v in ERP_SQL.items()) + "\n"


@query("erp_orders_assemble", _ERP_WITH + """
, pdim AS (select p.*, s.name as state_name, c.name as country_name
           from erp_partners p left join erp_states s on p.state_id = s.id
           left join erp_countries c on p.country_id = c.id),
ln AS (select l.*, row_number() over (partition by order_id order by sequence, id) as line_number
       from erp_order_lines l),
d AS (select id, try_strptime(split_part(date_order, ' ', 1), '%Y-%m-%d') as day from erp_orders)
select h.id as odoo_id, h.name as odoo_name, h.client_order_ref as shopify_order_number,
       cu.name as customer_name, cu.email as customer_email, h.date_order as order_date, h.state as order_status,
       h.invoice_status as payment_status, h.delivery_status, h.currency, h.amount_untaxed as subtotal,
       h.amount_tax as tax_amount, cast(null as double) as shipping_amount, cast(null as double) as discount_amount,
       h.amount_total as total_amount, cast(coalesce(ln.line_number, 1) as bigint) as line_number,
       ln.product_id, pr.default_code as product_default_code, pr.name as product_name,
       pr.description_sale as product_description, ln.product_uom_qty as product_quantity, ln.product_uom,
       ln.price_unit as product_unit_price, ln.price_subtotal as product_subtotal, ln.price_tax as product_tax,
       ln.price_total as product_total, h.note as notes,
       sh.name as shipping_name, sh.street as shipping_street, sh.street2 as shipping_street2, sh.city as shipping_city,
       sh.state_name as shipping_state, sh.zip as shipping_zip, sh.country_name as shipping_country, sh.phone as shipping_phone,
       iv.name as billing_name, iv.street as billing_street, iv.street2 as billing_street2, iv.city as billing_city,
       iv.state_name as billing_state, iv.zip as billing_zip, iv.country_name as billing_country, iv.phone as billing_phone,
       coalesce(strftime(d.day, '%d'), '00') as day_ordered,
       coalesce(strftime(d.day, '%m'), '00') as month_ordered,
       coalesce(cast(year(d.day) as varchar), '0000') as year_ordered
from erp_orders h
join d on d.id = h.id
left join pdim cu on h.partner_id = cu.id
left join pdim iv on h.partner_invoice_id = iv.id
left join pdim sh on h.partner_shipping_id = sh.id
left join ln on ln.order_id = h.id
left join erp_products pr on ln.product_id = pr.id""")
def q_erp_orders_assemble(spark, sf_dir):
    t = erp_landing(spark, sf_dir)
    return FL.erp_order_lines(t["erp_orders"], t["erp_order_lines"], t["erp_products"], t["erp_partners"],
                              t["erp_states"], t["erp_countries"])


@query("partner_ids_union", f"""
with erp_orders as ({ERP_SQL['erp_orders']})
select distinct partner_id from (
  select partner_id from erp_orders
  union all select partner_invoice_id from erp_orders
  union all select partner_shipping_id from erp_orders) t
where partner_id is not null""")
def q_partner_ids_union(spark, sf_dir):
    return FL.partner_ids(erp_landing(spark, sf_dir)["erp_orders"])
