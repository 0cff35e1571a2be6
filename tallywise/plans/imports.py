"""Import candidates: storefront order export lines and contacts that the
ERP does not hold yet.

Input: the order export landing frame with the export's own headers (see
EXPORT_RENAME for the canonical fixture names) and a row-order column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.functions import drop_offsets, nonempty
from tallywise.session import stage_rows
from tallywise.operators import first_row_per_group, flag_first_in_group, reindex

from tallywise.constants import (  # noqa: E402
    CONTACT_ADDRESS_TYPE, CONTACT_IS_COMPANY, CONTACT_KEEP, CONTACT_RENAME, CONTACT_TYPE, CONTACT_UPLOAD, EXPORT_OFFSETS,
    IMPORT_CUSTOMER, ORDER_KEEP, ORDER_UPLOAD,
)

# Canonical landing names of the fixture views -> the export's headers.
EXPORT_RENAME = {
    "name": "Name", "billing_name": "Billing Name", "paid_at": "Paid at",
    "quantity": "Lineitem quantity", "price": "Lineitem price", "sku": "Lineitem sku",
    "billing_country": "Billing Country", "email": "Email",
}
ROW_ORDER = "__row"


def export_frame(export: DataFrame, order_cols) -> DataFrame:
    """Rename canonical landing names to the export headers and attach a
    row-order column (the file order), carried through every step."""
    renamed = export.withColumnsRenamed({k: v for k, v in EXPORT_RENAME.items() if k in export.columns})
    return renamed.withColumn(ROW_ORDER, F.struct(*[F.col(c) for c in order_cols]))


def _fill_text(df: DataFrame) -> DataFrame:
    """Nulls in text columns become ''."""
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.fillna("", subset=text) if text else df


def import_orders(export: DataFrame, existing_orders: DataFrame) -> DataFrame:
    """Order lines not yet in the ERP; header fields only on each order's
    first remaining line."""
    df = reindex(export, ORDER_KEEP + [ROW_ORDER]).filter(nonempty(F.col("`Lineitem sku`")))
    df = _fill_text(df)
    known = existing_orders.select(F.col("name").alias("__known")).filter(F.col("__known").isNotNull())
    df = df.join(known, df["Name"] == known["__known"], "left_anti")
    df = stage_rows(df, "import-lines")  # read twice below
    df = flag_first_in_group(df, "Name", ROW_ORDER, "__first")
    first = F.col("__first")
    blank = F.lit("")
    return df.select(
        F.when(first, F.col("Name")).otherwise(blank).alias("Order Reference"),
        F.when(first, F.col("`Billing Name`")).otherwise(blank).alias("Delivery Address"),
        F.when(first, F.lit(IMPORT_CUSTOMER)).otherwise(blank).alias("Customer"),
        F.when(first, drop_offsets(F.col("`Paid at`"), EXPORT_OFFSETS)).otherwise(blank).alias("Order Date"),
        F.col("`Lineitem quantity`").alias("OrderLines/Quantity"),
        F.col("`Lineitem price`").alias("OrderLines/Price_unit"),
        F.col("`Lineitem sku`").alias("Order Lines/Product"),
    )


def import_contacts(export: DataFrame, existing_contacts: DataFrame) -> DataFrame:
    """Billing contacts not yet in the ERP, first occurrence per name. Of the ERP's partners only those of
    type ``contact`` count as known (all, where the read has no ``type``)."""
    df = reindex(export, CONTACT_KEEP + [ROW_ORDER]).filter(nonempty(F.col("`Billing Name`")))
    df = _fill_text(df).withColumnsRenamed(CONTACT_RENAME)
    df = first_row_per_group(df, "Name", ROW_ORDER,
                             cols=[c for c in CONTACT_UPLOAD if c in df.columns] + [ROW_ORDER])
    df = (df.withColumn("Is a company", F.lit(CONTACT_IS_COMPANY))
          .withColumn("Address type", F.lit(CONTACT_ADDRESS_TYPE)))
    if "type" in existing_contacts.columns:
        existing_contacts = existing_contacts.filter(F.col("type") == CONTACT_TYPE)
    known = existing_contacts.select(F.col("name").alias("__known")).filter(F.col("__known").isNotNull())
    df = df.join(known, df["Name"] == known["__known"], "left_anti")
    return df.select(*[F.col(f"`{c}`") for c in CONTACT_UPLOAD])


REINDEX_RENAME = {"name": "Name", "billing_name": "Billing Name", "paid_at": "Paid at",
                  "quantity": "Lineitem quantity", "price": "Lineitem price", "sku": "Lineitem sku"}
REINDEX_WANTED = ["Name", "Email", "Billing Name", "Paid at", "Lineitem quantity", "Lineitem price",
                  "Lineitem sku", "Billing Street"]
