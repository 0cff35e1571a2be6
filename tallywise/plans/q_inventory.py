"""Registered storefront-inventory queries."""

from __future__ import annotations

from tallywise.constants import CSV_RENAME
from tallywise.plans import inventory as V
from tallywise.plans.registry import query
from tallywise.sources.fixtures import FAMILY, SIZE_CASE, fixtures, with_clause
from tallywise.sources.nested import bulk_export_lines, catalog_pages
from tallywise.sources.rejects import read_documents
from tallywise.sources.sinks import ranked

_SKU = f"{FAMILY.format(k='p_partkey')} || '-' || {SIZE_CASE.format(k='p_partkey')}"
_SIZE = SIZE_CASE.format(k="p_partkey")
_IQ = "cast(case when p_partkey % 8 = 0 then 0 else p_size end as double)"
_PGID = "'gid://shopify/Product/' || cast(p_partkey as string)"
_VGID = "'gid://shopify/ProductVariant/' || cast(p_partkey as string)"

# Quantity overrides for listed SKUs (sku, on_hand, committed,
# available, unavailable, incoming).
OVERRIDES = [
    ("FAM-1-07G", 41.0, 41.0, 0.0, 0.0, 0.0),
    ("FAM-2-15G", 41.0, 41.0, 0.0, 0.0, 0.0),
    ("FAM-250-01G", 12.0, 3.0, 9.0, 0.0, 5.0),
    ("FAM-NONE-01G", 1.0, 1.0, 1.0, 1.0, 1.0),
]


@query("inventory_csv_by_sku", with_clause("inventory_csv") + """
select sku,
       arg_min(title, row_idx) filter (where title is not null) as title,
       cast(null as varchar) as handle,
       arg_min(option_value, row_idx) filter (where option_value is not null) as option_value,
       sum(coalesce(try_cast(incoming as double), 0)) as incoming,
       sum(coalesce(try_cast(unavailable as double), 0)) as unavailable,
       sum(coalesce(try_cast(committed as double), 0)) as committed,
       sum(coalesce(try_cast(available as double), 0)) as available,
       sum(coalesce(try_cast(on_hand as double), 0)) as on_hand
from inventory_csv
where (available is null or available <> 'not stocked') and sku is not null
group by sku""")
def q_inventory_csv_by_sku(spark, sf_dir):
    return V.inventory_by_sku(fixtures(spark, sf_dir).inventory_csv)


_CSV_COLUMNS = {v: k for k, v in CSV_RENAME.items() if v != "handle"}


@query("inventory_csv_import", with_clause("inventory_csv") + """
select sku, arg_min(title, row_idx) filter (where title is not null) as title, cast(null as varchar) as handle,
       arg_min(option_value, row_idx) filter (where option_value is not null) as option_value,
       sum(coalesce(try_cast(incoming as double), 0)) as incoming, sum(coalesce(try_cast(unavailable as double), 0)) as unavailable,
       sum(coalesce(try_cast(committed as double), 0)) as committed, sum(coalesce(try_cast(available as double), 0)) as available,
       sum(coalesce(try_cast(on_hand as double), 0)) as on_hand
from inventory_csv where (available is null or available <> 'not stocked') and sku is not null group by sku""")
def q_inventory_csv_import(spark, sf_dir):
    """The inventory export as a CSV file set with the storefront's headers and quoted line breaks; the
    first title and option of a SKU follow from the rows' places in the files."""
    import uuid

    from pyspark.sql import functions as F
    from tallywise.session import scratch_path
    from tallywise.sources.files import read_csv, write_csv
    path = scratch_path(spark, f"tallywise/inventory_export/{uuid.uuid4().hex}")
    rows = fixtures(spark, sf_dir).inventory_csv.orderBy("row_idx", "sku")
    write_csv(rows.select(F.concat(F.lit('Note "'), "row_idx", F.lit('",\nsecond line')).alias("Note"),
                          *[F.col(c).alias(h) for c, h in _CSV_COLUMNS.items()]), path)
    schema = ", ".join(f"`{h}` string" for h in CSV_RENAME)
    return V.inventory_from_csv(read_csv(spark, path, schema, position="line_no"), "line_no")


@query("report_inventory", with_clause("inventory_csv") + """
, inv AS (
select sku, arg_min(title, row_idx) filter (where title is not null) as title, cast(null as varchar) as handle,
       arg_min(option_value, row_idx) filter (where option_value is not null) as option_value,
       sum(coalesce(try_cast(incoming as double), 0)) as incoming, sum(coalesce(try_cast(unavailable as double), 0)) as unavailable,
       sum(coalesce(try_cast(committed as double), 0)) as committed, sum(coalesce(try_cast(available as double), 0)) as available,
       sum(coalesce(try_cast(on_hand as double), 0)) as on_hand
from inventory_csv where (available is null or available <> 'not stocked') and sku is not null group by sku)
select *, row_number() over (order by sku) as rank from inv""")
def q_report_inventory(spark, sf_dir):
    """The imported inventory in the order of its SKUs."""
    return ranked(V.inventory_by_sku(fixtures(spark, sf_dir).inventory_csv), V.INVENTORY_ORDER)


@query("inventory_totals", with_clause("storefront_inventory") + """
select sum(available) as total_available, sum(committed) as total_committed,
       sum(incoming) as total_incoming, sum(unavailable) as total_unavailable
from storefront_inventory""")
def q_inventory_totals(spark, sf_dir):
    return V.inventory_totals(fixtures(spark, sf_dir).storefront_inventory)


_OV_VALUES = ", ".join(
    f"('{s}', {a}::double, {b}::double, {c}::double, {d}::double, {e}::double)" for s, a, b, c, d, e in OVERRIDES)


@query("inventory_override", with_clause("storefront_inventory") + f"""
, ov AS (select * from (values {_OV_VALUES}) as t(sku, on_hand, committed, available, unavailable, incoming))
select s.sku, s.title, s.option_value,
       coalesce(ov.on_hand, s.on_hand) as on_hand, coalesce(ov.available, s.available) as available,
       coalesce(ov.committed, s.committed) as committed, coalesce(ov.unavailable, s.unavailable) as unavailable,
       coalesce(ov.incoming, s.incoming) as incoming
from storefront_inventory s left join ov on s.sku = ov.sku""")
def q_inventory_override(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return V.apply_overrides(fx.storefront_inventory, V.overrides_frame(spark, OVERRIDES))


@query("inventory_override_zero", with_clause("storefront_inventory") + f"""
, ov AS (select * from (values {_OV_VALUES}) as t(sku, on_hand, committed, available, unavailable, incoming)),
m AS (
select s.*, ov.on_hand as ov_on_hand, ov.committed as ov_committed,
       ov.sku is not null and (s.on_hand = 0 or s.committed = 0) as hit
from storefront_inventory s left join ov on s.sku = ov.sku)
select sku, title, option_value, case when hit then ov_on_hand else on_hand end as on_hand, available,
       case when hit then ov_committed else committed end as committed, unavailable, incoming
from m""")
def q_inventory_override_zero(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return V.apply_overrides(fx.storefront_inventory, V.overrides_frame(spark, OVERRIDES), only_if_zero=True)


def _classified(spark, sf_dir):
    return V.classify_records(bulk_export_lines(spark, sf_dir))


@query("bulk_records_split", f"""
select 'product' as kind, {_PGID} as record_id, cast(null as varchar) as parent_id,
       cast(null as varchar) as sku, p_name as title, cast(null as double) as inventory_quantity,
       p_partkey * 10 as line_no
from part where p_partkey % 29 <> 0
union all
select 'variant', {_VGID}, {_PGID}, case when p_partkey % 13 = 0 then null else {_SKU} end, {_SIZE},
       {_IQ} + case when p_partkey % 9 = 0 and p_partkey % 13 <> 0 then 100 else 0 end,
       p_partkey * 10 + case when p_partkey % 9 = 0 and p_partkey % 13 <> 0 then 5 else 1 end
from part
union all
select 'level', null, {_VGID}, null, null, null, p_partkey * 10 + 2 from part where p_partkey % 7 <> 0
union all
select 'level', null, {_VGID}, null, null, null, p_partkey * 10 + 3
from part where p_partkey % 7 <> 0 and p_partkey % 3 = 0""")
def q_bulk_records_split(spark, sf_dir):
    return V.records_split(_classified(spark, sf_dir))


@query("quantities_pivot", with_clause("storefront_inventory") + f"""
select p_partkey * 10 + 2 as line_no, {_VGID} as parent_id, 'Main' as location,
       s.available, s.on_hand, s.committed, s.incoming
from part join storefront_inventory s on s.sku = {_SKU}
union all
select p_partkey * 10 + 3, {_VGID}, 'Annex', cast(1 as double), cast(3 as double), cast(0 as double), cast(0 as double)
from part where p_partkey % 7 <> 0 and p_partkey % 3 = 0""")
def q_quantities_pivot(spark, sf_dir):
    _, _, levels = V.split_records(_classified(spark, sf_dir), materialize=False)
    return V.quantities_pivot(levels)


_BULK_EXPECTED = with_clause("storefront_inventory") + f"""
, b AS (
select {_SKU} as sku, p_partkey as pk, p_name, {_SIZE} as option_value, s.sku is not null as has_lv,
       s.available as s_av, s.on_hand as s_oh, s.committed as s_cm, s.incoming as s_in,
       {_IQ} + case when p_partkey % 9 = 0 then 100 else 0 end as iq2
from part left join storefront_inventory s on s.sku = {_SKU}
where p_partkey % 13 <> 0),
r AS (
select sku, case when pk % 29 <> 0 then p_name end as title,
       case when pk % 29 <> 0 then lower(replace(p_name, ' ', '-')) end as handle, option_value, has_lv,
       case when has_lv then s_av + case when pk % 3 = 0 then 1 else 0 end else iq2 end as available,
       case when has_lv then s_oh + case when pk % 3 = 0 then 3 else 0 end else iq2 end as on_hand,
       case when has_lv then s_cm else 0 end as committed,
       case when has_lv then s_in else 0 end as incoming
from b),
inv AS (
select sku, title, handle, option_value, cast(incoming as double) as incoming,
       cast(case when has_lv then greatest(0, on_hand - available) else 0 end as double) as unavailable,
       cast(committed as double) as committed, cast(available as double) as available,
       cast(on_hand as double) as on_hand
from r)
"""


@query("bulk_inventory_file", _BULK_EXPECTED + "select * from inv")
def q_bulk_inventory_file(spark, sf_dir):
    """The bulk export landed as a JSON-lines file set and read back."""
    import uuid

    from pyspark.sql import functions as F
    from tallywise.session import scratch_path
    from tallywise.sources.files import read_json_lines
    path = scratch_path(spark, f"tallywise/bulk_export/{uuid.uuid4().hex}")
    # File order = record order: range-partition by line number, so part
    # files (named by partition) follow each other in order.
    bulk_export_lines(spark, sf_dir).orderBy("line_no").select("value").write.text(path)
    return V.bulk_inventory(V.classify_records(read_json_lines(spark, path)))[0]


@query("bulk_inventory", _BULK_EXPECTED + "select * from inv")
def q_bulk_inventory(spark, sf_dir):
    return V.bulk_inventory(_classified(spark, sf_dir))[0]


@query("bulk_products", _BULK_EXPECTED + """
select sku, title, handle, option_value as option1, on_hand as inventory_quantity,
       on_hand as old_inventory_quantity, 'active' as status from inv""")
def q_bulk_products(spark, sf_dir):
    return V.bulk_inventory(_classified(spark, sf_dir))[1]


_CATALOG_SQL = f"""
with f as (select cast(floor(p_partkey / 4) as bigint) as fam, min(p_name) as title from part group by 1)
select cast(f.fam as string) as product_id, {_SKU} as sku, f.title, 'fam-' || cast(f.fam as string) as handle,
       {_SIZE} as option_value, case when f.fam % 11 = 0 then 'archived' else 'active' end as status,
       {_IQ} + case when p_partkey % 6 = 0 then 1 else 0 end as inventory_quantity,
       {_IQ} + case when p_partkey % 6 = 0 then 1 else 0 end as on_hand,
       {_IQ} + case when p_partkey % 6 = 0 then 1 else 0 end as available,
       cast(0 as double) as committed, cast(0 as double) as unavailable, cast(0 as double) as incoming
from part join f on f.fam = cast(floor(p_partkey / 4) as bigint)
where p_partkey % 19 <> 0"""


@query("catalog_flatten", _CATALOG_SQL)
def q_catalog_flatten(spark, sf_dir):
    return V.catalog_flatten(catalog_pages(spark, sf_dir))


@query("catalog_flatten_file", _CATALOG_SQL)
def q_catalog_flatten_file(spark, sf_dir):
    """Catalogue pages landed as JSON files, read with the declared schema."""
    import uuid

    from tallywise.session import scratch_path
    path = scratch_path(spark, f"tallywise/catalog_pages/{uuid.uuid4().hex}")
    catalog_pages(spark, sf_dir).select("body").write.text(path)
    return V.catalog_flatten_parsed(read_documents(spark, path, V.PAGE_SCHEMA).rows)


@query("catalog_flatten_rejects", _CATALOG_SQL.replace("select cast(f.fam", "select 'row' as kind, cast(f.fam", 1)
       + """ and f.fam // 50 % 4 <> 1
union all
select distinct 'reject', cast(cast(floor(p_partkey / 4) as bigint) // 50 as varchar), null, null, null, null, null, null, null, null, null, null, null
from part where cast(floor(p_partkey / 4) as bigint) // 50 % 4 = 1""")
def q_catalog_flatten_rejects(spark, sf_dir):
    """Every fourth catalogue page lands cut off: the rows of the others, and one reject a page."""
    import uuid

    from pyspark.sql import functions as F
    from tallywise.session import scratch_path
    path = scratch_path(spark, f"tallywise/catalog_pages/{uuid.uuid4().hex}")
    body = F.when(F.col("page_no") % 4 == 1, F.expr("substring(body, 1, length(body) - 9)")).otherwise(F.col("body"))
    catalog_pages(spark, sf_dir).select(F.concat(F.lit('{"page":'), F.col("page_no"), F.lit(","), F.substr(body, F.lit(2))).alias("value")).write.text(path)
    found = read_documents(spark, path, V.PAGE_SCHEMA, keep_broken=True)
    rows = V.catalog_flatten_parsed(found.rows)
    gone = found.rejects.select(F.regexp_extract("value", r'"page":(\d+)', 1).alias("product_id"))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields if f.name != "product_id"]
    return (rows.withColumn("kind", F.lit("row"))
            .unionByName(gone.select(F.lit("reject").alias("kind"), "product_id", *empty)))


@query("json_path", """
select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events""")
def q_json_path(spark, sf_dir):
    from pyspark.sql import functions as F
    ev = fixtures(spark, sf_dir).table("events")
    return ev.select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))
