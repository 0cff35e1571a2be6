"""Fixed values.

Values that must equal the source workflow's for results to match: status
labels, tolerances, thresholds, default texts, location and category
filters, export and upload headers, and the mismatch note. Kept together,
as plain text, in their natural order.
"""

# ---- Fixed values: order comparison ---------------------------------------
SYNC_STATUSES = ("Missing in Shopify", "Missing in Odoo", "Quantity mismatch", "Price mismatch", "Synced")
PRICE_TOLERANCE = 0.01
SYNC_ACTIONS = {"import": ("Missing in Odoo",), "update": ("Quantity mismatch", "Price mismatch")}
LEGACY_SKU_SUFFIX = "-01G"
DEFAULT_LOOKBACK_DAYS = 90

# ---- Fixed values: flattened storefront orders -----------------------------
DEFAULT_FULFILLMENT = "unfulfilled"
DEFAULT_RISK = "Unknown"
DEFAULT_PRODUCT_STATUS = "active"
PAID_STATUS = "paid"

# ---- Fixed values: stock cross-reference -----------------------------------
STOCK_LOCATION_PATTERN = "F%"
STOCK_TRACKING = "none"
STOCK_CATEGORY = "Plant"
ACTIVE_STATUS = "active"
SIZE_BAND = 5.0
MISMATCH_THRESHOLD = 5.0
SIZE_MISMATCH_NOTE = ("Size mismatch: Odoo has ", " but Shopify has ", " with matching quantity")

# ---- Fixed values: storefront inventory ------------------------------------
NOT_STOCKED = "not stocked"
LEVEL_NAMES = ["available", "on_hand", "committed", "incoming"]
CSV_RENAME = {"SKU": "sku", "Title": "title", "Handle": "handle", "Option1 Value": "option_value",
              "Incoming": "incoming", "Unavailable": "unavailable", "Committed": "committed",
              "Available": "available", "On hand": "on_hand"}

# ---- Fixed values: pull sheet ----------------------------------------------
PULL_LOCATION_PATTERN = "F%"
STOCK_PREFIX = "F/Stock/"
PICKING_RENAME = {
    "Stock Moves": "order_text",
    "Stock Moves/Product": "item",
    "Stock Moves/Move Line/From": "location",
    "Stock Moves/Quantity": "quantity",
    "Stock Moves/Product/Quantity On Hand": "on_hand",
}

# ---- Fixed values: import candidates ---------------------------------------
EXPORT_OFFSETS = (" -0500", " -0400")
ORDER_KEEP = ["Name", "Billing Name", "Paid at", "Lineitem quantity", "Lineitem price", "Lineitem sku"]
CONTACT_KEEP = ["Email", "Billing Name", "Billing Street", "Billing City", "Billing Zip",
                "Billing Province", "Billing Country", "Billing Phone"]
CONTACT_RENAME = {"Billing Name": "Name", "Billing Street": "Street", "Billing City": "City",
                  "Billing Zip": "Zip", "Billing Province": "State", "Billing Country": "Country",
                  "Billing Phone": "Phone"}
ORDER_UPLOAD = ["Order Reference", "Delivery Address", "Customer", "Order Date",
                "OrderLines/Quantity", "OrderLines/Price_unit", "Order Lines/Product"]
CONTACT_UPLOAD = ["Email", "Name", "Street", "City", "Zip", "State", "Country", "Phone",
                  "Is a company", "Address type"]
IMPORT_CUSTOMER = "Shopify"
CONTACT_IS_COMPANY = "0"
CONTACT_ADDRESS_TYPE = "Contact"
CONTACT_TYPE = "contact"
