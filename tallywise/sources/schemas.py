"""Declared schemas of the landing data (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ADDRESS = T.StructType([T.StructField(n, T.StringType()) for n in (
    "first_name", "last_name", "address1", "address2", "company", "city", "zip", "province",
    "province_code", "country_code", "phone")])

LINE_ITEM = T.StructType([
    T.StructField("line_no", T.LongType()), T.StructField("sku", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("quantity", T.DoubleType()),
    T.StructField("price", T.StringType()), T.StructField("vendor", T.StringType()),
    T.StructField("requires_shipping", T.BooleanType()), T.StructField("taxable", T.BooleanType()),
    T.StructField("fulfillment_status", T.StringType()),
    T.StructField("variant", T.StructType([T.StructField("compare_at_price", T.StringType())])),
    T.StructField("discount_allocations", T.ArrayType(T.StructType([T.StructField("amount", T.StringType())]))),
    T.StructField("tax_lines", T.ArrayType(T.StructType([
        T.StructField("title", T.StringType()), T.StructField("price", T.StringType())]))),
])

def _texts(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _array(*fields: T.StructField) -> T.ArrayType:
    return T.ArrayType(T.StructType(list(fields)))


# Storefront order document: the fields that the flatten reads.
ORDER = T.StructType([
    T.StructField("id", T.LongType()),
    *_texts("name", "email", "phone", "financial_status", "fulfillment_status", "processed_at", "created_at",
            "cancelled_at", "currency", "subtotal_price", "total_tax", "total_price", "total_discounts",
            "total_duties", "note", "tags", "source_name", "checkout_token", "cart_token"),
    T.StructField("checkout_id", T.LongType()),
    T.StructField("buyer_accepts_marketing", T.BooleanType()),
    T.StructField("total_shipping_price_set", T.StructType([
        T.StructField("shop_money", T.StructType(_texts("amount")))])),
    T.StructField("discount_codes", _array(*_texts("code"))),
    T.StructField("shipping_lines", _array(*_texts("title"))),
    T.StructField("fulfillments", _array(*_texts("created_at"))),
    T.StructField("note_attributes", _array(*_texts("name", "value"))),
    T.StructField("payment_gateway_names", T.ArrayType(T.StringType())),
    T.StructField("payment_terms", T.StructType(_texts("payment_terms_name", "next_payment_due_at"))),
    T.StructField("refunds", _array(*_texts("kind"), T.StructField("transactions", _array(
        *_texts("kind"), T.StructField("amount", T.DoubleType()))))),
    T.StructField("billing_address", _ADDRESS), T.StructField("shipping_address", _ADDRESS),
    T.StructField("order_risk", T.StructType(_texts("level"))),
    T.StructField("line_items", T.ArrayType(LINE_ITEM)),
])


def parse_orders(text: DataFrame, col: str = "value") -> DataFrame:
    """JSON order documents (one per row) to typed columns; a broken document fails the load
    (``rejects.split_documents`` keeps it apart instead)."""
    return text.select(F.from_json(F.col(col), ORDER, {"mode": "FAILFAST"}).alias("o")).select("o.*")


def read_orders_json(spark: SparkSession, path: str) -> DataFrame:
    """Order pages landed as JSON lines; each file is one page (union all). A broken document fails the load."""
    return spark.read.schema(ORDER).option("mode", "FAILFAST").json(path)
