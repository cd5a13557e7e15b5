"""Feed schemas, target types and value domains.

FIXED VALUES - these must equal the source system's for equal results:
domains, tolerances, reason codes, segment names, calendar bounds.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
FEEDS = ["orders", "order_lines", "customers", "products", "payments", "deliveries"]

ORDER_STATUSES = ["PENDING", "CONFIRMED", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED"]
CHANNELS = ["WEB", "MOBILE_APP", "WHATSAPP_BOT", "CALL_CENTER", "AGENT_BIZ"]
PAYMENT_STATUSES = ["PENDING", "AUTHORIZED", "CAPTURED", "FAILED", "REFUNDED"]
CURRENCIES = ["XOF", "GHS", "NGN"]
COUNTRIES = ["SEN", "GHA", "NGA", "CIV"]
GENDERS = ["M", "F", "OTHER", "NOT_DECLARED"]
CATEGORIES = ["Mode", "Électronique", "Maison", "Beauté", "Alimentation", "Bébé & Enfant", "Sport", "Téléphonie"]
PAYMENT_METHODS = ["OM_MOBILE_MONEY", "WAVE", "MTN_MOMO", "CARD", "COD", "BANK_TRANSFER"]
DELIVERY_STATUSES = ["PREPARING", "IN_TRANSIT", "OUT_FOR_DELIVERY", "DELIVERED", "FAILED", "RETURNED_TO_WAREHOUSE"]
CUSTOMER_SEGMENTS = ["NEW", "REGULAR", "VIP", "DORMANT"]

AMOUNT_TOLERANCE = "0.05"  # compared as an exact decimal
LATE_DAYS = 7
# order statuses that do not count as a completed sale
NOT_COMPLETED = ["CANCELLED", "RETURNED", "PENDING"]
# order statuses left out of the return-rate mart (RETURNED is kept there)
NOT_IN_RETURN_RATE = ["CANCELLED", "PENDING"]
# an order in one of these states while its delivery says DELIVERED is a conflict
CONFLICTING_ORDER_STATUSES = ["CONFIRMED", "PROCESSING", "SHIPPED"]

MOBILE_MONEY_METHODS = ["OM_MOBILE_MONEY", "WAVE", "MTN_MOMO"]
FINAL_DELIVERY_STATUSES = ["DELIVERED", "FAILED", "RETURNED_TO_WAREHOUSE"]
NO_PAYMENT_METHOD = "NONE"
NO_DELIVERY_STATUS = "NO_DELIVERY"

RFM_SEGMENTS = ["CHAMPIONS", "LOYAL", "NEW_OR_PROMISING", "AT_RISK", "LOST", "NEED_ATTENTION"]
ABC_A_SHARE = "0.80"
ABC_B_SHARE = "0.95"
DORMANT_DAYS = 90
SLOW_UNITS_90D = 3
RECENT_DAYS = 90

OPEN_START = "1900-01-01 00:00:00"
OPEN_END = "9999-12-31 00:00:00"
UNKNOWN_MEMBER = "-1"

CALENDAR_START = "2024-01-01"
CALENDAR_END = "2027-12-31"
DEFAULT_AS_OF = "2026-05-01"

CURRENCY_RATES = [("XOF", "1.0"), ("GHS", "1.0"), ("NGN", "1.0")]
# ---------------------------------------------------------------- end of fixed values

# Curated target types, per feed (column -> Spark SQL type).  Columns not
# listed keep their input type (identifiers and free text).
TARGET_TYPES: dict[str, dict[str, str]] = {
    "orders": {
        "order_date": "timestamp",
        "subtotal_amount": "decimal(12,2)",
        "shipping_amount": "decimal(10,2)",
        "discount_amount": "decimal(10,2)",
        "total_amount": "decimal(12,2)",
        "created_at": "timestamp",
        "updated_at": "timestamp",
    },
    "order_lines": {
        "quantity": "int",
        "unit_price": "decimal(10,2)",
        "line_discount": "decimal(10,2)",
        "line_total": "decimal(12,2)",
    },
    "customers": {"birth_year": "int", "registration_date": "date"},
    "products": {
        "unit_cost": "decimal(10,2)",
        "unit_price": "decimal(10,2)",
        "weight_grams": "int",
        "is_perishable": "boolean",
        "created_at": "timestamp",
        "updated_at": "timestamp",
    },
    "payments": {"payment_amount": "decimal(12,2)", "payment_date": "timestamp"},
    "deliveries": {
        "shipped_at": "timestamp",
        "delivered_at": "timestamp",
        "delivery_attempts": "int",
        "delivery_cost": "decimal(10,2)",
    },
}

FEED_COLUMNS: dict[str, list[str]] = {
    "orders": [
        "order_id", "order_number", "customer_id", "order_date", "order_status", "channel", "country_code",
        "delivery_address_city", "delivery_address_region", "delivery_address_zone", "promo_code", "currency",
        "subtotal_amount", "shipping_amount", "discount_amount", "total_amount", "created_at", "updated_at",
    ],
    "order_lines": [
        "order_line_id", "order_id", "product_id", "product_sku", "quantity", "unit_price", "line_discount",
        "line_total", "seller_id",
    ],
    "customers": [
        "customer_id", "email_hash", "phone_hash", "birth_year", "gender", "registration_date", "country_code",
        "city", "customer_segment", "preferred_payment_method", "loyalty_tier", "account_status",
    ],
    "products": [
        "product_id", "sku", "product_name", "category_id", "category_name", "subcategory_name", "brand",
        "seller_id", "unit_cost", "unit_price", "weight_grams", "is_perishable", "created_at", "updated_at",
        "product_status",
    ],
    "payments": [
        "payment_id", "order_id", "payment_method", "payment_provider", "payment_amount", "currency",
        "payment_status", "payment_date", "transaction_reference",
    ],
    "deliveries": [
        "delivery_id", "order_id", "carrier", "tracking_number", "delivery_status", "shipped_at",
        "delivered_at", "delivery_attempts", "delivery_cost",
    ],
}

FEED_KEYS = {
    "orders": "order_id",
    "order_lines": "order_line_id",
    "customers": "customer_id",
    "products": "product_id",
    "payments": "payment_id",
    "deliveries": "delivery_id",
}

# Columns removed from quarantine payloads (data minimisation), and unsalted hashes that get the salt there too.
PAYLOAD_REDACT = {"customers": ["first_name", "last_name"]}
PAYLOAD_HASHES = {"customers": ["email_hash", "phone_hash"]}

LINEAGE_COLUMNS = ["_source_file", "_ingested_at", "_run_date"]


def text_schema(feed: str, extra: list[str] | None = None) -> T.StructType:
    """All-string schema of a raw feed (what a CSV landing produces)."""
    cols = FEED_COLUMNS[feed] + (extra or [])
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])
