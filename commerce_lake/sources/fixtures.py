"""Mapping of the test tables (TPC-H-like parquet) onto the six retail feeds.

Anomalies are injected by key arithmetic so that every rule of the curated
zone has rows to act on (second order versions, orphan products, shared and
repeated customer ids, zero prices, partial and double payments, pending
deliveries).  Every rule here is a narrow projection of one table (one
window for the line ids), so the mapping scales with the tables.

FIXED VALUES of the mapping (position = key modulo the list length):
  order status by order_id % 7:  PENDING, CONFIRMED, PROCESSING, SHIPPED, CANCELLED, RETURNED, DELIVERED
  country by customer_id % 4:    SEN, CIV, GHA, NGA
  currency by customer_id % 4:   XOF, XOF, GHS, NGN
  channel by order_id % 5:       WEB, MOBILE_APP, WHATSAPP_BOT, CALL_CENTER, AGENT_BIZ
  payment method by order_id % 6: OM_MOBILE_MONEY, WAVE, MTN_MOMO, CARD, COD, BANK_TRANSFER
  gender by customer_id % 4:     M, F, OTHER, NOT_DECLARED
  loyalty tier by customer_id % 3: BRONZE, SILVER, GOLD
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATUS_BY_MOD7 = ["PENDING", "CONFIRMED", "PROCESSING", "SHIPPED", "CANCELLED", "RETURNED", "DELIVERED"]
COUNTRY_BY_MOD4 = ["SEN", "CIV", "GHA", "NGA"]
CURRENCY_BY_MOD4 = ["XOF", "XOF", "GHS", "NGN"]
CHANNEL_BY_MOD5 = ["WEB", "MOBILE_APP", "WHATSAPP_BOT", "CALL_CENTER", "AGENT_BIZ"]
METHOD_BY_MOD6 = ["OM_MOBILE_MONEY", "WAVE", "MTN_MOMO", "CARD", "COD", "BANK_TRANSFER"]
GENDER_BY_MOD4 = ["M", "F", "OTHER", "NOT_DECLARED"]
TIER_BY_MOD3 = ["BRONZE", "SILVER", "GOLD"]
CARRIER_BY_MOD3 = ["DHL", "LOCAL_EXPRESS", "POSTE"]

# the run the fixture pretends to be
RUN_DATE = "2001-08-02"
INGESTED_AT = "2001-08-02 06:00:00"
AS_OF_DATE = "2001-08-02"  # day after the last order date of the tables
HASH_SALT = "fixture-salt"
ORPHAN_OFFSET = 10_000_000


def pick(values: Sequence[str], key: str) -> str:
    """SQL text of values[key % len(values)]."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({key}) % {len(values)} {whens} END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Projections are SQL expression text: one planner call per projection
# instead of one JVM round trip per column operator.
LINEAGE = [f"CAST('{INGESTED_AT}' AS TIMESTAMP) AS _ingested_at", f"'{RUN_DATE}' AS _run_date"]


def _lineage(df: DataFrame, feed: str) -> DataFrame:
    return df.selectExpr("*", f"'{feed}.csv' AS _source_file", *LINEAGE)


def base_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "concat('ORD-', CAST(o_orderkey AS STRING)) AS order_number",
        "o_custkey AS customer_id",
        "CAST(o_orderdate AS TIMESTAMP) AS order_date",
        f"{pick(STATUS_BY_MOD7, 'o_orderkey')} AS order_status",
        f"{pick(CHANNEL_BY_MOD5, 'o_orderkey')} AS channel",
        f"{pick(COUNTRY_BY_MOD4, 'o_custkey')} AS country_code",
        "concat('CITY-', CAST(o_custkey % 20 AS STRING)) AS delivery_address_city",
        "concat('REGION-', CAST(o_custkey % 5 AS STRING)) AS delivery_address_region",
        "CASE WHEN o_custkey % 2 = 0 THEN 'URBAN' ELSE 'RURAL' END AS delivery_address_zone",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'PROMO5' END AS promo_code",
        f"{pick(CURRENCY_BY_MOD4, 'o_custkey')} AS currency",
        "CAST(o_totalprice AS DECIMAL(12,2)) AS subtotal_amount",
        "CAST(10 AS DECIMAL(10,2)) AS shipping_amount",
        "CAST(5 AS DECIMAL(10,2)) AS discount_amount",
        "CAST(CAST(o_totalprice AS DECIMAL(12,2)) + CAST(CASE WHEN o_orderkey % 97 = 0 THEN 105 ELSE 5 END"
        " AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS total_amount",
        "CAST(o_orderdate AS TIMESTAMP) AS created_at",
        "CAST(o_orderdate AS TIMESTAMP) AS updated_at",
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base_orders(spark, sf_dir)
    second = b.where("order_id % 33 = 0").withColumns(
        {"order_status": F.lit("DELIVERED"), "updated_at": F.expr("updated_at + INTERVAL 1 DAY")}
    )
    return _lineage(b.unionByName(second), "orders")


def raw_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines numbered 1.. within their order by every other column.  The
    number comes from ``row_number_within`` (heavy orders in slices), so one
    order holding a third of all lines is still numbered by many tasks."""
    from commerce_lake.operators.ranking import row_number_within

    others = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate"]
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", *others)
    numbered = row_number_within(li, ["l_orderkey"], others, "_rn")
    return _lineage(
        numbered.selectExpr(
            "concat_ws('-', l_orderkey, _rn) AS order_line_id",
            "l_orderkey AS order_id",
            f"CASE WHEN (l_orderkey + l_partkey) % 50 = 0 THEN l_partkey + {ORPHAN_OFFSET} ELSE l_partkey END"
            " AS product_id",
            "concat('SKU-', CAST(l_partkey AS STRING)) AS product_sku",
            "CAST(l_quantity AS INT) AS quantity",
            # whole cents, floor-divided by the quantity: exact in every engine
            "CAST(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) div CAST(l_quantity AS BIGINT) AS DECIMAL(18,0))"
            " * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS unit_price",
            "CAST(0 AS DECIMAL(10,2)) AS line_discount",
            "CAST(l_extendedprice AS DECIMAL(12,2)) AS line_total",
            "l_suppkey AS seller_id",
        ),
        "order_lines",
    )


def _customer_rows(c: DataFrame, email_sql: str) -> DataFrame:
    return c.selectExpr(
        "c_custkey AS customer_id",
        f"{email_sql} AS email_hash",
        "md5(concat('tel-', CAST(c_custkey AS STRING))) AS phone_hash",
        "CAST(1940 + c_custkey % 70 AS INT) AS birth_year",
        f"{pick(GENDER_BY_MOD4, 'c_custkey')} AS gender",
        "date_add(DATE'1994-01-01', CAST(c_custkey % 365 AS INT)) AS registration_date",
        f"{pick(COUNTRY_BY_MOD4, 'c_custkey')} AS country_code",
        "CAST(c_nationkey AS STRING) AS city",
        "c_mktsegment AS customer_segment",
        f"{pick(METHOD_BY_MOD6, 'c_custkey')} AS preferred_payment_method",
        f"{pick(TIER_BY_MOD3, 'c_custkey')} AS loyalty_tier",
        "'ACTIVE' AS account_status",
        # the two name columns exist in the feed and are never carried forward
        "c_name AS first_name",
        "concat('N', CAST(c_custkey AS STRING)) AS last_name",
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    first = _customer_rows(c, "md5(CAST(CASE WHEN c_custkey % 60 = 1 THEN c_custkey - 1 ELSE c_custkey END AS STRING))")
    second = _customer_rows(c.where("c_custkey % 500 = 7"), "md5(concat('x', CAST(c_custkey AS STRING)))")
    return _lineage(first.unionByName(second), "customers")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineage(
        table(spark, sf_dir, "part").selectExpr(
            "p_partkey AS product_id",
            "concat('SKU-', CAST(p_partkey AS STRING)) AS sku",
            "p_name AS product_name",
            "p_type AS category_id",
            "p_type AS category_name",
            "CAST(p_size AS STRING) AS subcategory_name",
            "p_brand AS brand",
            "p_partkey % 100 AS seller_id",
            "CAST(CASE WHEN p_partkey % 100 = 0 THEN 0 WHEN p_partkey % 200 = 1 THEN 2000 ELSE 600 END"
            " AS DECIMAL(10,2)) AS unit_cost",
            "CAST(CASE WHEN p_partkey % 100 = 0 THEN 0.0D ELSE p_retailprice END AS DECIMAL(10,2)) AS unit_price",
            "CAST(p_size * 100 AS INT) AS weight_grams",
            "p_size % 5 = 0 AS is_perishable",
            "TIMESTAMP'2024-01-01 00:00:00' AS created_at",
            "TIMESTAMP'2024-01-01 00:00:00' AS updated_at",
            "'ACTIVE' AS product_status",
        ),
        "products",
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base_orders(spark, sf_dir).where("order_id % 10 <> 9")
    first = b.selectExpr(
        "order_id * 10 AS payment_id",
        "order_id",
        f"{pick(METHOD_BY_MOD6, 'order_id')} AS payment_method",
        "concat('PSP-', CAST(order_id % 3 AS STRING)) AS payment_provider",
        "CASE WHEN order_id % 50 = 3 THEN CAST(500 AS DECIMAL(12,2)) ELSE total_amount END AS payment_amount",
        "currency",
        "CASE WHEN order_id % 13 = 0 THEN 'FAILED' ELSE 'CAPTURED' END AS payment_status",
        "order_date + INTERVAL 1 DAY AS payment_date",
        "concat('TX-', CAST(order_id * 10 AS STRING)) AS transaction_reference",
    )
    second = b.where("order_id % 100 = 4").selectExpr(
        "order_id * 10 + 1 AS payment_id",
        "order_id",
        "'CARD' AS payment_method",
        "concat('PSP-', CAST(order_id % 3 AS STRING)) AS payment_provider",
        "total_amount AS payment_amount",
        "currency",
        "'CAPTURED' AS payment_status",
        "order_date + INTERVAL 2 DAY AS payment_date",
        "concat('TX-', CAST(order_id * 10 + 1 AS STRING)) AS transaction_reference",
    )
    return _lineage(first.unionByName(second), "payments")


def raw_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineage(
        base_orders(spark, sf_dir).where("order_id % 5 <> 0").selectExpr(
            "order_id AS delivery_id",
            "order_id",
            f"{pick(CARRIER_BY_MOD3, 'order_id')} AS carrier",
            "concat('TRK-', CAST(order_id AS STRING)) AS tracking_number",
            "CASE WHEN order_id % 3 = 0 THEN 'IN_TRANSIT' ELSE 'DELIVERED' END AS delivery_status",
            "order_date + INTERVAL 1 DAY AS shipped_at",
            "CASE WHEN order_id % 3 <> 0 THEN order_date + make_dt_interval(CAST(order_id % 12 AS INT)) END"
            " AS delivered_at",
            "CAST(1 AS INT) AS delivery_attempts",
            "CAST(5 AS DECIMAL(10,2)) AS delivery_cost",
        ),
        "deliveries",
    )


RAW_BUILDERS = {
    "orders": raw_orders,
    "order_lines": raw_order_lines,
    "customers": raw_customers,
    "products": raw_products,
    "payments": raw_payments,
    "deliveries": raw_deliveries,
}


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}


def cached_raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Same frames for every query of one session: the plans are built once
    (nothing is persisted; this only saves driver-side planning calls)."""
    cache = spark.__dict__.setdefault("_cl_raw_feeds", {})
    if sf_dir not in cache:
        cache[sf_dir] = raw_feeds(spark, sf_dir)
    return dict(cache[sf_dir])


# ----------------------------------------------------------------------------- made versions
# Fixed rules, repeated in the oracle: three versions of each customer and 65 of each product over the order
# dates, and what three snapshot runs saw.  All follow from the keys of the curated tables.
def customer_versions(customers: DataFrame) -> DataFrame:
    at = "TIMESTAMP'1995-01-01 00:00:00' + make_dt_interval(CAST(customer_id * 37 % 700 + ({j}) * 500 AS INT))"
    return customers.selectExpr("customer_id", "explode(sequence(0, 2)) AS version_no").selectExpr(
        "customer_id", "version_no",
        f"CASE WHEN version_no = 0 THEN TIMESTAMP'1900-01-01 00:00:00' ELSE {at.format(j='version_no')} END AS valid_from",
        f"CASE WHEN version_no = 2 THEN TIMESTAMP'9999-12-31 00:00:00' ELSE {at.format(j='version_no + 1')} END AS valid_to")


def product_versions(products: DataFrame) -> DataFrame:
    """Every ninth version ends 20 days before the next one begins."""
    return products.selectExpr("product_id", "explode(sequence(0, 64)) AS version_no").selectExpr(
        "product_id", "version_no",
        "TIMESTAMP'1994-01-01 00:00:00' + make_dt_interval(CAST(product_id % 45 + version_no * 45 AS INT)) AS valid_from",
        "TIMESTAMP'1994-01-01 00:00:00' + make_dt_interval(CAST(product_id % 45 + (version_no + 1) * 45"
        " - IF(version_no % 9 = 4, 20, 0) AS INT)) AS valid_to")


def customer_runs(customers: DataFrame) -> list[tuple[str, DataFrame]]:
    """(run time, what the run saw): some customers are missing in a run, some change, one change is not tracked."""
    second = {"customer_segment": F.expr("IF(customer_id % 7 = 0, 'VIP', customer_segment)"),
              "city": F.expr("IF(customer_id % 17 = 0, NULL, city)")}
    third = {"customer_segment": F.expr("IF(customer_id % 14 = 0, 'VIP', customer_segment)"),
             "birth_year": F.expr("IF(customer_id % 5 = 0, 2000, birth_year)")}
    return [("2001-08-02 00:00:00", customers.where("customer_id % 11 <> 3")),
            ("2001-08-03 00:00:00", customers.where("customer_id % 13 <> 5").withColumns(second)),
            ("2001-08-04 00:00:00", customers.withColumns(third))]


def product_runs(products: DataFrame) -> list[DataFrame]:
    """What three runs saw: newer versions, changes under an old time, and an older time after a newer one."""
    second = {"updated_at": F.expr("IF(product_id % 3 = 0, updated_at + INTERVAL 10 DAY, updated_at)"),
              "unit_cost": F.expr("CAST(IF(product_id % 3 = 0 OR product_id % 5 = 0, unit_cost + 1, unit_cost) AS DECIMAL(10,2))")}
    third = {"updated_at": F.expr("IF(product_id % 4 = 0, updated_at + INTERVAL 5 DAY, updated_at)")}
    return [products, products.withColumns(second), products.withColumns(third)]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
