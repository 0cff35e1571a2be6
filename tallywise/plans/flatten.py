"""Nested documents to line rows: storefront orders, ERP order assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.functions import (
    array_text, first_text, full_name, join_field, nth_field, plant_name, sum_field, sum_nested_where,
    yes_no,
)
from tallywise.operators import broadcast_if_small, number_within_group

from tallywise.constants import DEFAULT_FULFILLMENT, DEFAULT_RISK


# Parts of an address and the output names they get.
ADDRESS_PARTS = {"street": "address1", "address1": "address1", "address2": "address2", "company": "company",
                 "city": "city", "zip": "zip", "province": "province_code", "country": "country_code", "phone": "phone"}
# Fields of the output that the source always leaves empty.
ALWAYS_EMPTY = ["tax3_name", "tax3_value", "tax4_name", "tax4_value", "tax5_name", "tax5_value",
                "receipt_number", "payment_references"]
NO_PROVINCE, NO_GATEWAY, NO_SOURCE = "Unknown", "Unknown", "web"


def _address(role: str) -> list:
    """Output columns of the billing or shipping address; an order without it has a blank name."""
    a = F.col(f"{role}_address")
    return [full_name(a.getField("first_name"), a.getField("last_name")).alias(f"{role}_name"),
            *[a.getField(f).alias(f"{role}_{n}") for n, f in ADDRESS_PARTS.items()],
            F.coalesce(a.getField("province"), F.lit(NO_PROVINCE)).alias(f"{role}_province_name")]


def _order_fields() -> list:
    return [
        "name", "email", "financial_status", F.col("processed_at").alias("paid_at"),
        first_text("fulfillment_status", default=DEFAULT_FULFILLMENT).alias("fulfillment_status"),
        nth_field("fulfillments", 0, "created_at").alias("fulfilled_at"),
        yes_no("buyer_accepts_marketing").alias("accepts_marketing"), "currency",
        F.col("subtotal_price").alias("subtotal"),
        F.col("total_shipping_price_set.shop_money.amount").alias("shipping"),
        F.col("total_tax").alias("taxes"), F.col("total_price").alias("total"),
        join_field("discount_codes", "code").alias("discount_code"),
        F.col("total_discounts").alias("discount_amount"),
        nth_field("shipping_lines", 0, "title").alias("shipping_method"), "created_at",
        *_address("billing"), *_address("shipping"),
        F.col("note").alias("notes"), array_text("note_attributes").alias("note_attributes"), "cancelled_at",
        F.coalesce(F.try_element_at("payment_gateway_names", F.lit(1)), F.lit(NO_GATEWAY)).alias("payment_method"),
        F.coalesce(F.nullif(F.col("checkout_token"), F.lit("")), F.col("cart_token")).alias("payment_reference"),
        # the source asks the refund for its kind, not the transaction
        sum_nested_where("refunds", "transactions", "amount", "kind", "refund", kind_level="outer").alias("refunded_amount"),
        "tags",
        F.when(F.col("order_risk").isNotNull(), F.col("order_risk.level"))
         .otherwise(F.lit(DEFAULT_RISK)).alias("risk_level"),
        F.col("id").alias("shopify_id"), F.coalesce("source_name", F.lit(NO_SOURCE)).alias("source"),
        F.coalesce("phone", F.lit("")).alias("phone"), F.col("total_duties").alias("duties"),
        F.col("checkout_id").alias("payment_id"), F.col("payment_terms.payment_terms_name"),
        F.col("payment_terms.next_payment_due_at"),
        *[F.lit(None).cast("string").alias(n) for n in ALWAYS_EMPTY],
    ]


def flatten_orders(docs: DataFrame) -> DataFrame:
    """One row per order line; an order without lines keeps one row with
    line number 1 and empty line fields.

    All fields of the source's order lines, but for its always empty ``Id``
    (the table's surrogate key has that name) and the paid date's parts,
    which the refresh task adds."""
    heads = docs.select(*_order_fields(), "line_items")  # once per order, not per line
    fields = heads.columns[:-1]
    x = heads.select(*fields, F.posexplode_outer("line_items").alias("__pos", "__li"))
    li = F.col("__li")
    has_line = li.isNotNull()
    return x.select(
        *fields,
        *[li.getField(f).alias(f"lineitem_{f}") for f in
          ("quantity", "name", "price", "sku", "requires_shipping", "taxable", "fulfillment_status")],
        li.getField("variant").getField("compare_at_price").alias("lineitem_compare_at_price"),
        li.getField("vendor").alias("vendor"),
        F.when(has_line, sum_field(li.getField("discount_allocations"), "amount")).alias("lineitem_discount"),
        *[nth_field(li.getField("tax_lines"), n - 1, f).alias(f"tax{n}_{out}")
          for n in (1, 2) for f, out in (("title", "name"), ("price", "value"))],
        (F.coalesce(F.col("__pos"), F.lit(0)) + 1).cast("bigint").alias("lineitem_number"),
        F.when(has_line, plant_name(li.getField("name"))).alias("plantname"),
    )


def line_array_fields(lines: DataFrame, refund_kind_level: str = "inner") -> DataFrame:
    """Array-derived line fields: discount codes, first two taxes, discount
    total, refunded amount and the code list as JSON text."""
    return lines.select(
        "l_orderkey", "line_no",
        join_field("discount_codes", "code").alias("discount_code"),
        nth_field("tax_lines", 0, "title").alias("tax1_name"),
        nth_field("tax_lines", 0, "price").alias("tax1_value"),
        nth_field("tax_lines", 1, "title").alias("tax2_name"),
        nth_field("tax_lines", 1, "price").alias("tax2_value"),
        sum_field("discount_allocations", "amount").alias("lineitem_discount"),
        sum_nested_where("refunds", "transactions", "amount", "kind", "refund",
                         kind_level=refund_kind_level).alias("refunded_amount"),
        array_text(F.transform("discount_codes", lambda d: d.getField("code"))).alias("discount_codes_text"),
    )


# Parts of a partner's address in the ERP order lines.
PARTNER_PARTS = {"name": "name", "street": "street", "street2": "street2", "city": "city", "state": "state_name",
                 "zip": "zip", "country": "country_name", "phone": "phone"}


# Roles a partner has in an order header, and the header's column with its id.
PARTNER_ROLES = {"cust": "partner_id", "inv": "partner_invoice_id", "ship": "partner_shipping_id"}


def with_partners(orders: DataFrame, partners: DataFrame) -> DataFrame:
    """Order headers with their partners in all roles, one struct column per role, and a meeting key ``__k``.

    The partners that headers ask for travel as (key, partner id) pairs: only these go to the
    partners and come back, so a wide header moves once instead of once per role, and is then
    distributed by ``__k`` as the lines are by order id. ``__k`` is the order id, or a hash where that
    is null; a header picks its partners by their ids, so it does not matter who else meets there.
    Partner rows with one id are all kept: each gives a header row of its own, as in a join.
    """
    keys = list(PARTNER_ROLES.values())
    heads = orders.withColumn("__k", F.coalesce("id", F.xxhash64(*keys).cast(orders.schema["id"].dataType)))
    asked = (heads.select("__k", F.explode(F.array_distinct(F.array(*keys))).alias("__pid"))
             .filter(F.col("__pid").isNotNull()))
    rows = (partners.groupBy(F.col("id").alias("__id"))
            .agg(F.array_sort(F.collect_list(F.struct(*[c for c in partners.columns if c != "id"]))).alias("rows")))
    found = (asked.join(rows, asked["__pid"] == rows["__id"]).groupBy("__k")
             .agg(F.collect_set(F.struct(F.col("__pid").alias("id"), "rows")).alias("__found"))
             .withColumnRenamed("__k", "__fk"))
    h = heads.join(found, heads["__k"] == found["__fk"], "left")
    for role, key in PARTNER_ROLES.items():
        own = F.filter("__found", lambda x: x.getField("id") == F.col(key))
        h = h.select("*", F.explode_outer(F.try_element_at(own, F.lit(1)).getField("rows")).alias(role))
    return h.drop("__found", "__fk")


def erp_order_lines(orders: DataFrame, lines: DataFrame, products: DataFrame, partners: DataFrame,
                    states: DataFrame, countries: DataFrame) -> DataFrame:
    """ERP sale orders flattened to line rows.

    Partners are resolved once into a dimension with state and country names
    (the tiny state/country tables are broadcast), then given to the order
    headers in three roles (``with_partners``) before the (larger) lines are attached. Lines are
    numbered per order by (sequence, id); orders without lines keep one row.
    The source never fills the shipping and discount amounts; its load stamps
    (created and updated) are added by the refresh task.
    """
    st = broadcast_if_small(states.select(F.col("id").alias("__sid"), F.col("name").alias("state_name")))
    co = broadcast_if_small(countries.select(F.col("id").alias("__cid"), F.col("name").alias("country_name")))
    pdim = (partners.join(st, partners["state_id"] == st["__sid"], "left")
            .join(co, partners["country_id"] == co["__cid"], "left")
            .select("id", "name", "email", "phone", "street", "street2", "city", "zip", "state_name", "country_name"))
    h = with_partners(orders.filter(F.col("id").isNotNull()), pdim)
    no_id = with_partners(orders.filter(F.col("id").isNull()), pdim)  # apart: these meet no line

    ln = number_within_group(lines, "order_id", ["sequence", "id"], out="line_number").select(
        F.col("id").alias("line_id"), "order_id", "product_id", "product_uom_qty", "product_uom", "price_unit", "price_subtotal",
        "price_tax", "price_total", "line_number")
    pr = products.select(F.col("id").alias("__prod"), F.col("default_code").alias("product_default_code"),
                         F.col("name").alias("product_name"),
                         F.col("description_sale").alias("product_description"))
    ln = ln.join(pr, ln["product_id"] == pr["__prod"], "left").drop("__prod")
    # orders LEFT JOIN lines, written so that a huge order stays splittable:
    # lines x headers is an inner join (AQE may split either side), and the
    # lineless headers come from an anti join against distinct order ids.
    # Both read the same distributed headers.
    with_lines = ln.join(h, ln["order_id"] == h["__k"]).drop("line_id")
    has_lines = lines.select(F.col("order_id").alias("__oid")).distinct()
    lineless = h.join(has_lines, h["__k"] == has_lines["__oid"], "left_anti")
    j = with_lines.unionByName(lineless, allowMissingColumns=True).unionByName(no_id, allowMissingColumns=True)

    day = F.try_to_date(F.substring_index(F.col("date_order"), " ", 1), "yyyy-MM-dd")
    return j.select(
        F.col("id").alias("odoo_id"), F.col("name").alias("odoo_name"),
        F.col("client_order_ref").alias("shopify_order_number"),
        F.col("cust.name").alias("customer_name"), F.col("cust.email").alias("customer_email"),
        F.col("date_order").alias("order_date"), F.col("state").alias("order_status"),
        F.col("invoice_status").alias("payment_status"), "delivery_status", "currency",
        F.col("amount_untaxed").alias("subtotal"), F.col("amount_tax").alias("tax_amount"),
        F.lit(None).cast("double").alias("shipping_amount"), F.lit(None).cast("double").alias("discount_amount"),
        F.col("amount_total").alias("total_amount"),
        F.coalesce(F.col("line_number"), F.lit(1).cast("bigint")).alias("line_number"),
        F.col("product_id"), "product_default_code", "product_name", "product_description",
        F.col("product_uom_qty").alias("product_quantity"), "product_uom",
        F.col("price_unit").alias("product_unit_price"), F.col("price_subtotal").alias("product_subtotal"),
        F.col("price_tax").alias("product_tax"), F.col("price_total").alias("product_total"),
        *[F.col(f"{p}.{f}").alias(f"{role}_{n}") for p, role in (("ship", "shipping"), ("inv", "billing"))
          for n, f in PARTNER_PARTS.items()],
        F.col("note").alias("notes"),
        F.coalesce(F.date_format(day, "dd"), F.lit("00")).alias("day_ordered"),
        F.coalesce(F.date_format(day, "MM"), F.lit("00")).alias("month_ordered"),
        F.coalesce(F.year(day).cast("string"), F.lit("0000")).alias("year_ordered"),
    )


def partner_ids(orders: DataFrame) -> DataFrame:
    """Distinct partner ids over the three roles (null roles skipped)."""
    roles = [orders.select(F.col(c).alias("partner_id")) for c in
             ("partner_id", "partner_invoice_id", "partner_shipping_id")]
    out = roles[0].union(roles[1]).union(roles[2])
    return out.filter(F.col("partner_id").isNotNull()).distinct()
