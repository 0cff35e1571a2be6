"""Storefront inventory ingest: CSV export, bulk-export JSON lines,
catalogue pages, overrides and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.functions import last_path_part, non_negative, nonempty, to_number_or_zero
from tallywise.operators import broadcast_if_small, first_non_null, last_wins, rename_require

QTY_COLS = ["incoming", "unavailable", "committed", "available", "on_hand"]
INVENTORY_COLS = ["sku", "title", "handle", "option_value"] + QTY_COLS
from tallywise.constants import CSV_RENAME, DEFAULT_PRODUCT_STATUS, LEVEL_NAMES, NOT_STOCKED


#: The grouped table is read in the order of its key.
INVENTORY_ORDER = ["sku"]


def inventory_by_sku(csv_rows: DataFrame, order: str = "row_idx") -> DataFrame:
    """Per SKU: quantities summed over locations (bad numbers count 0), first
    non-null text fields in file order; ``not stocked`` rows and rows without
    a SKU are dropped. Input uses the table's column names (see CSV_RENAME)."""
    df = csv_rows
    for c in ("title", "handle", "option_value"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.filter(~F.col("available").cast("string").eqNullSafe(F.lit(NOT_STOCKED)) & F.col("sku").isNotNull())
    return df.groupBy("sku").agg(
        first_non_null("title", order), first_non_null("handle", order), first_non_null("option_value", order),
        *[F.sum(to_number_or_zero(c)).alias(c) for c in QTY_COLS]).select(*INVENTORY_COLS)


def inventory_from_csv(export: DataFrame, position: str) -> DataFrame:
    """Per SKU inventory of an export with the storefront's own headers (see ``inventory_by_sku``)."""
    return inventory_by_sku(rename_require(export, CSV_RENAME, ["sku", *QTY_COLS]), position)


def inventory_totals(inventory: DataFrame) -> DataFrame:
    return inventory.agg(*[F.sum(c).alias(f"total_{c}") for c in
                           ("available", "committed", "incoming", "unavailable")])


def apply_overrides(inventory: DataFrame, overrides: DataFrame, only_if_zero: bool = False) -> DataFrame:
    """Keyed quantity overrides for listed SKUs (a small broadcast dimension).

    ``only_if_zero`` applies an override only where on-hand or committed is 0,
    and then to these two quantities alone.
    """
    changed = ("on_hand", "committed") if only_if_zero else QTY_COLS
    ov = broadcast_if_small(overrides.select("sku", *[F.col(c).alias(f"__ov_{c}") for c in QTY_COLS]))
    j = inventory.join(ov, "sku", "left")
    hit = F.col("__ov_on_hand").isNotNull()
    if only_if_zero:
        hit = hit & ((F.col("on_hand") == 0) | (F.col("committed") == 0))
    cols = [F.when(hit, F.col(f"__ov_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in inventory.columns]
    return j.select(*cols)


def overrides_frame(spark: SparkSession, rows) -> DataFrame:
    names = "sku, on_hand, committed, available, unavailable, incoming"
    if not rows:
        return spark.createDataFrame([], "sku string, " + ", ".join(f"{c} double" for c in names.split(", ")[1:]))
    # literal rows have true statistics, so the small side is known to be small
    args, values = {}, []
    for n, (sku, *qty) in enumerate(rows):
        args[f"s{n}"] = sku
        args.update({f"q{n}_{k}": float(q) for k, q in enumerate(qty)})
        values.append(f"(:s{n}, " + ", ".join(f":q{n}_{k}" for k in range(len(qty))) + ")")
    return spark.sql(f"select * from values {', '.join(values)} as t({names})", args)


# ---------------------------------------------------------------- bulk export
BULK_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("handle", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("__parentId", T.StringType()), T.StructField("sku", T.StringType()),
    T.StructField("inventoryQuantity", T.DoubleType()),
    T.StructField("location", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("quantities", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("quantity", T.DoubleType())]))),
])


def classify_records(lines: DataFrame) -> DataFrame:
    """Parse JSON lines ``(value, line_no)`` and tell record kinds apart by
    key presence, first rule wins: product, variant, inventory level.
    Well-formed lines of no known kind are dropped; a line that is no JSON object
    fails the load, as in the source. A key present with a null value counts
    as present, as in the source."""
    said = F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring("value", 1, 200)))
    parsed = lines.select("line_no", F.from_json("value", BULK_SCHEMA).alias("r"),
                          F.when(F.trim("value") != "", F.coalesce(F.json_object_keys("value"), said.cast("array<string>"))).alias("k"))
    has = lambda key: F.coalesce(F.array_contains(F.col("k"), key), F.lit(False))
    parent = F.col("r.__parentId")
    truthy_parent = F.coalesce(parent != "", F.lit(False))
    kind = (F.when(has("id") & has("title") & has("handle") & ~truthy_parent, F.lit("product"))
            .when(truthy_parent & has("sku"), F.lit("variant"))
            .when(truthy_parent & has("quantities"), F.lit("level")))
    return parsed.select(
        "line_no", kind.alias("kind"),
        F.col("r.id").alias("record_id"), parent.alias("parent_id"),
        F.col("r.sku").alias("sku"), F.col("r.title").alias("title"), F.col("r.handle").alias("handle"),
        F.when(has("status"), F.col("r.status")).otherwise(F.lit(DEFAULT_PRODUCT_STATUS)).alias("status"),
        F.coalesce(F.col("r.inventoryQuantity"), F.lit(0.0)).alias("inventory_quantity"),
        F.col("r.location.name").alias("location"), F.col("r.quantities").alias("quantities"),
    ).filter(F.col("kind").isNotNull())


def split_records(classified: DataFrame, materialize: bool = True):
    """(products, variants, levels). Products and variants: the last record
    per id wins; a variant keeps the line of its first appearance as its
    position (dict insertion order). Levels are all kept.

    The parsed records feed three branches; with ``materialize`` they are
    staged once (Parquet, in the shared folder) instead of parsing the
    JSON three times.
    """
    if materialize:
        from tallywise.session import stage_rows
        classified = stage_rows(classified, "bulk-records")
    prod = last_wins(classified.filter(F.col("kind") == "product"), "record_id", "line_no",
                     cols=["title", "handle", "status", "line_no"])
    var_rows = classified.filter(F.col("kind") == "variant")
    variants = var_rows.groupBy("record_id").agg(
        F.max_by(F.struct("parent_id", "sku", "title", "inventory_quantity", "line_no"), F.col("line_no")).alias("v"),
        F.min("line_no").alias("first_line"))
    variants = variants.select("record_id", "v.*", "first_line")
    levels = classified.filter(F.col("kind") == "level").select("line_no", "parent_id", "location", "quantities")
    return prod, variants, levels


def records_split(classified: DataFrame) -> DataFrame:
    """All kept records in one frame (products, variants, levels)."""
    prod, variants, levels = split_records(classified)
    p = prod.select(F.lit("product").alias("kind"), "record_id", F.lit(None).cast("string").alias("parent_id"),
                    F.lit(None).cast("string").alias("sku"), "title",
                    F.lit(None).cast("double").alias("inventory_quantity"), "line_no")
    v = variants.select(F.lit("variant").alias("kind"), "record_id", "parent_id", "sku", "title",
                        "inventory_quantity", "line_no")
    lv = levels.select(F.lit("level").alias("kind"), F.lit(None).cast("string").alias("record_id"), "parent_id",
                       F.lit(None).cast("string").alias("sku"), F.lit(None).cast("string").alias("title"),
                       F.lit(None).cast("double").alias("inventory_quantity"), "line_no")
    return p.unionByName(v).unionByName(lv)


def named_quantity(arr, name: str):
    """Quantity of the last entry called ``name`` in ``[{name, quantity}]``; 0 if none."""
    hit = F.try_element_at(F.filter(arr, lambda q: q.getField("name") == F.lit(name)), F.lit(-1))
    return F.coalesce(hit.getField("quantity"), F.lit(0.0))


def quantities_pivot(levels: DataFrame) -> DataFrame:
    """One row per inventory level with the four named quantities as columns."""
    return levels.select("line_no", "parent_id", "location",
                         *[named_quantity(F.col("quantities"), n).alias(n) for n in LEVEL_NAMES])


def bulk_inventory(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(inventory table, product table) from classified bulk records.

    Levels are summed per variant (map-side combined); variants join their
    product and level sums; variants without levels use their own quantity.
    """
    prod, variants, levels = split_records(classified)
    sums = quantities_pivot(levels).groupBy(F.col("parent_id").alias("__vid")).agg(
        *[F.sum(n).alias(f"__{n}") for n in LEVEL_NAMES])
    p = prod.select(F.col("record_id").alias("__pid"), F.col("title").alias("__ptitle"),
                    F.col("handle").alias("__phandle"))
    j = (variants.join(p, variants["parent_id"] == p["__pid"], "left")
         .join(sums, variants["record_id"] == sums["__vid"], "left"))
    has_levels = F.col("__vid").isNotNull()
    own = F.col("inventory_quantity")
    rec = j.select(
        "sku", "first_line",
        F.col("__ptitle").alias("title"), F.col("__phandle").alias("handle"),
        F.col("title").alias("option_value"),
        F.when(has_levels, F.col("__available")).otherwise(own).alias("available"),
        F.when(has_levels, F.col("__on_hand")).otherwise(own).alias("on_hand"),
        F.coalesce(F.col("__committed"), F.lit(0.0)).alias("committed"),
        F.coalesce(F.col("__incoming"), F.lit(0.0)).alias("incoming"),
        F.when(has_levels, non_negative(F.col("__on_hand") - F.col("__available")))
         .otherwise(F.lit(0.0)).alias("unavailable"),
    )
    inv = rec.filter(F.col("sku").isNotNull()).groupBy("sku").agg(
        first_non_null("title", "first_line"), first_non_null("handle", "first_line"),
        first_non_null("option_value", "first_line"),
        *[F.sum(c).alias(c) for c in QTY_COLS]).select(*INVENTORY_COLS)
    products = inv.select("sku", "title", "handle", F.col("option_value").alias("option1"),
                          F.col("on_hand").alias("inventory_quantity"),
                          F.col("on_hand").alias("old_inventory_quantity"),
                          F.lit(DEFAULT_PRODUCT_STATUS).alias("status"))
    return inv, products


# ---------------------------------------------------------------- catalogue
_VARIANT_NODE = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("sku", T.StringType()),
    T.StructField("title", T.StringType()), T.StructField("inventoryQuantity", T.DoubleType()),
    T.StructField("inventoryItem", T.StructType([T.StructField("inventoryLevel", T.StructType([
        T.StructField("quantity", T.DoubleType())]))])),
])
_PRODUCT_NODE = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("handle", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("variants", T.StructType([T.StructField("edges", T.ArrayType(T.StructType([
        T.StructField("node", _VARIANT_NODE)])))])),
])
PAGE_SCHEMA = T.StructType([T.StructField("data", T.StructType([T.StructField("products", T.StructType([
    T.StructField("edges", T.ArrayType(T.StructType([T.StructField("node", _PRODUCT_NODE)])))]))]))])


def catalog_flatten(pages: DataFrame, body: str = "body") -> DataFrame:
    """Catalogue pages -> one row per variant with a SKU (two-level explode).

    A page that is no JSON of the schema fails the load (``rejects.split_documents`` keeps
    it apart instead). Quantity: the stock level's if present, else the variant's, else 0.
    Status is lower-cased at ingest so later filters on 'active' work.
    """
    return catalog_flatten_parsed(pages.select(F.from_json(F.col(body), PAGE_SCHEMA, {"mode": "FAILFAST"}).getField("data").alias("data")))


def catalog_tables(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(inventory table, product table) of flattened catalogue pages."""
    inventory = flat.select(*INVENTORY_COLS)
    products = flat.select("sku", "title", "handle", F.col("option_value").alias("option1"), "inventory_quantity",
                           F.col("inventory_quantity").alias("old_inventory_quantity"), "status")
    return inventory, products


def catalog_flatten_parsed(pages: DataFrame) -> DataFrame:
    """Same as ``catalog_flatten`` for pages already parsed with PAGE_SCHEMA
    (for example ``rejects.read_documents(spark, folder, PAGE_SCHEMA).rows``)."""
    prods = pages.select(F.explode(F.col("data.products.edges")).alias("e"))
    prods = prods.select(F.col("e.node").alias("p"))
    vars_ = prods.select("p", F.explode(F.col("p.variants.edges")).alias("ve")).select("p", F.col("ve.node").alias("v"))
    q = F.coalesce(F.col("v.inventoryItem.inventoryLevel.quantity"), F.col("v.inventoryQuantity"), F.lit(0.0))
    zero = F.lit(0.0)
    return vars_.filter(nonempty(F.col("v.sku"))).select(
        last_path_part(F.col("p.id")).alias("product_id"), F.col("v.sku").alias("sku"),
        F.col("p.title").alias("title"), F.col("p.handle").alias("handle"),
        F.col("v.title").alias("option_value"), F.lower(F.col("p.status")).alias("status"),
        q.alias("inventory_quantity"), q.alias("on_hand"), q.alias("available"),
        zero.alias("committed"), zero.alias("unavailable"), zero.alias("incoming"))
