"""Registered import-candidate queries."""

from __future__ import annotations

from tallywise.operators import keep_available, reindex, rename_require
from tallywise.plans import imports as I
from tallywise.plans.registry import query
from tallywise.sources.fixtures import fixtures, with_clause


LINE_ORDER = ("l_orderkey", "line_no")

_IMPORT_ORDERS_SQL = with_clause("order_export", "existing_orders") + """
, f AS (select coalesce(name, '') as name, coalesce(billing_name, '') as billing_name,
               coalesce(paid_at, '') as paid_at, quantity, price, coalesce(sku, '') as sku,
               l_orderkey, line_no from order_export),
k AS (select * from f where sku != ''
        and not exists (select 1 from existing_orders e where e.name = f.name)),
r AS (select *, row_number() over (partition by name order by l_orderkey, line_no) as rn from k)
select case when rn = 1 then name else '' end as "Order Reference",
       case when rn = 1 then billing_name else '' end as "Delivery Address",
       case when rn = 1 then 'Shopify' else '' end as "Customer",
       case when rn = 1 then replace(replace(paid_at, ' -0500', ''), ' -0400', '') else '' end as "Order Date",
       quantity as "OrderLines/Quantity", price as "OrderLines/Price_unit", sku as "Order Lines/Product"
from r"""


@query("import_orders_new", _IMPORT_ORDERS_SQL)
def q_import_orders_new(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return I.import_orders(I.export_frame(fx.order_export, LINE_ORDER), fx.existing_orders)


@query("import_contacts_new", with_clause("order_export", "existing_contacts") + """
, f AS (select '' as "Email", coalesce(billing_name, '') as "Name", '' as "Street", '' as "City",
               '' as "Zip", '' as "State", coalesce(billing_country, '') as "Country", '' as "Phone",
               l_orderkey, line_no from order_export),
k AS (select *, row_number() over (partition by "Name" order by l_orderkey, line_no) as rn
      from f where "Name" != '')
select "Email", "Name", "Street", "City", "Zip", "State", "Country", "Phone",
       '0' as "Is a company", 'Contact' as "Address type"
from k where rn = 1 and not exists (select 1 from existing_contacts e where e.name = k."Name" and e.type = 'contact')""")
def q_import_contacts_new(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return I.import_contacts(I.export_frame(fx.order_export, LINE_ORDER), fx.existing_contacts)


@query("reindex_columns", with_clause("order_export") + """
select name as "Name", cast(null as varchar) as "Email", billing_name as "Billing Name",
       paid_at as "Paid at", quantity as "Lineitem quantity", price as "Lineitem price",
       sku as "Lineitem sku", cast(null as varchar) as "Billing Street"
from order_export""")
def q_reindex_columns(spark, sf_dir):
    df = fixtures(spark, sf_dir).order_export
    df = rename_require(df, I.REINDEX_RENAME, ["Name", "Lineitem sku"])
    offered = keep_available(df, [c for c in I.REINDEX_WANTED if c in df.columns])
    return reindex(offered, I.REINDEX_WANTED)


# Export file layout: the export's own headers; the rows' order is that of the file.
ORDER_CSV_SCHEMA = ("`Name` string, `Billing Name` string, `Paid at` string, `Lineitem quantity` double, "
                    "`Lineitem price` double, `Lineitem sku` string, `Billing Country` string")


@query("import_orders_csv", _IMPORT_ORDERS_SQL)
def q_import_orders_csv(spark, sf_dir):
    """Same candidates, read from a header CSV export landed in the shared
    folder with a declared schema (never inferred)."""
    import uuid

    from tallywise.session import scratch_path
    from tallywise.sources.files import read_csv, write_csv
    fx = fixtures(spark, sf_dir)
    path = scratch_path(spark, f"tallywise/orders_export/{uuid.uuid4().hex}")
    export = fx.order_export.withColumnsRenamed({k: v for k, v in I.EXPORT_RENAME.items()
                                                 if k in fx.order_export.columns})
    write_csv(export.orderBy("l_orderkey", "line_no").drop("l_orderkey", "line_no"), path)
    landed = read_csv(spark, path, ORDER_CSV_SCHEMA, position="line_no")
    return I.import_orders(I.export_frame(landed, ["line_no"]), fx.existing_orders)
