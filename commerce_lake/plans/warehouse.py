"""Staging views, intermediate models, dimensions, fact and marts.

Everything reads the curated tables (a dict of DataFrames) and returns lazy
DataFrames.  Physical notes:
* the only explicit broadcast has a size fixed in advance: the currency
  rate seed (three rows);
* every other join is an equi-join; a curated table is broadcast only if its
  counted rows fit the session's threshold in memory (``joined_side``), never
  for the size of its compressed files;
* the two global windows of the marts have no PARTITION BY, which would funnel
  every row through one task: RFM quintiles compare rows with exact cut keys
  (``operators.cuts``, no sort), the ABC running share uses the scale-out
  running sum of ``operators.ranking``;
* distinct counts that are implied by keys are plain counts; the return-rate
  mart aggregates lines to orders first and then orders to groups, which
  replaces two DISTINCT aggregates (an Expand of every row) by a partial
  aggregation per level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.functions.expr import date_key, dec, md5_key, year_month
from commerce_lake.operators.asof import asof_ordered
from commerce_lake.operators.cuts import cut_ntiles
from commerce_lake.operators.ranking import global_running_sum
from commerce_lake.operators.skew import heavy_keys
from commerce_lake.operators.scd2 import dimension_view, snapshot_check, snapshot_timestamp
from commerce_lake.operators.upsert import ChangeLog, upsert_frames
from commerce_lake.plans.curated import Part, joined_side
from commerce_lake.schemas import (
    ABC_A_SHARE,
    ABC_B_SHARE,
    CURRENCY_RATES,
    DORMANT_DAYS,
    FINAL_DELIVERY_STATUSES,
    MOBILE_MONEY_METHODS,
    NO_DELIVERY_STATUS,
    NO_PAYMENT_METHOD,
    NOT_COMPLETED,
    NOT_IN_RETURN_RATE,
    RECENT_DAYS,
    SLOW_UNITS_90D,
)

CUSTOMER_CHECK_COLS = [
    "master_customer_id", "customer_segment", "loyalty_tier", "account_status", "city", "country_code",
    "preferred_payment_method",
]


# ----------------------------------------------------------------------------- staging
def stg_orders(cur: dict[str, DataFrame]) -> DataFrame:
    return cur["orders"].select(
        "order_id", "order_number", "customer_id", "order_date", "order_status", "channel", "country_code",
        F.col("delivery_address_city").alias("city"), F.col("delivery_address_region").alias("region"),
        F.col("delivery_address_zone").alias("zone"), "promo_code", "currency", "subtotal_amount",
        "shipping_amount", "discount_amount", "total_amount", "captured_amount", "has_payment",
        "is_partial_payment", "customer_dq_flag", "order_year_month", "created_at", "updated_at",
    )


def stg_order_lines(cur: dict[str, DataFrame]) -> DataFrame:
    return cur["order_lines"].select(
        "order_line_id", "order_id", "product_id", "product_sku", "quantity", "unit_price", "line_discount",
        "line_total", "seller_id", "order_year_month",
    )


def stg_customers(cur: dict[str, DataFrame]) -> DataFrame:
    return cur["customers"].select(
        "customer_id", "master_customer_id", "is_duplicate_account", "email_hash", "phone_hash", "birth_year",
        "gender", "registration_date", "country_code", "city", "customer_segment", "preferred_payment_method",
        "loyalty_tier", "account_status",
    )


def stg_products(cur: dict[str, DataFrame]) -> DataFrame:
    return cur["products"].select(
        "product_id", "sku", "product_name", "category_id", "category_name", "subcategory_name", "brand",
        "seller_id", "unit_cost", "unit_price", "weight_grams", "is_perishable", "created_at", "updated_at",
        "product_status", "dq_flag",
    )


def stg_payments(cur: dict[str, DataFrame]) -> DataFrame:
    """Payments of retained orders only (IN (subquery) = left semi join)."""
    kept = joined_side(cur, "orders", cur["orders"].select("order_id"))
    return cur["payments"].join(kept, "order_id", "left_semi").select(
        "payment_id", "order_id", "payment_method", "payment_provider", "payment_amount", "currency",
        "payment_status", "payment_date", "transaction_reference", "is_selected",
    )


def stg_deliveries(cur: dict[str, DataFrame]) -> DataFrame:
    return cur["deliveries"].select(
        "delivery_id", "order_id", "carrier", "tracking_number", "delivery_status", "shipped_at", "delivered_at",
        "delivery_attempts", "delivery_cost", "delivery_delay_days", "is_late", "status_conflict",
    )


def stg_quarantine(cur: dict[str, DataFrame]) -> DataFrame:
    q = cur["quarantine"]
    return q.select("source", "record_key", "reason", F.to_date("run_date").alias("run_date"), "payload")


def stg_currency_rates(spark: SparkSession) -> DataFrame:
    """Static seed table (three rows)."""
    return spark.createDataFrame(CURRENCY_RATES, "currency string, rate string").select(
        "currency", F.col("rate").cast("decimal(12,6)").alias("rate_to_reference")
    )


# ----------------------------------------------------------------------------- intermediate
def lines_enriched(cur: dict[str, DataFrame]) -> DataFrame:
    """Lines with the current catalogue cost and the margin."""
    ol = stg_order_lines(cur)
    p = joined_side(cur, "products", stg_products(cur).select("product_id", "unit_cost"))
    return ol.join(p, "product_id", "inner").select(
        "order_line_id", "order_id", "product_id", "seller_id", "quantity", "unit_price", "line_discount",
        "line_total", "unit_cost",
        (F.col("quantity") * F.col("unit_cost")).alias("line_cost"),
        (F.col("line_total") - F.col("quantity") * F.col("unit_cost")).alias("line_margin"),
    )


def orders_enriched(cur: dict[str, DataFrame]) -> DataFrame:
    """Orders with the selected payment's method and the delivery (a second
    delivery of one order would add a row, as in the source model)."""
    o = stg_orders(cur)
    sp = joined_side(cur, "payments", stg_payments(cur).where(F.col("is_selected")).select("order_id", "payment_method"))
    d = joined_side(cur, "deliveries", stg_deliveries(cur).select("order_id", "delivery_status", "delivery_delay_days", "is_late"))
    return o.join(sp, "order_id", "left").join(d, "order_id", "left").select(
        "order_id", "customer_id", "order_date", "order_status", "channel", "country_code", "currency", "zone",
        "is_partial_payment",
        F.coalesce(F.col("payment_method"), F.lit(NO_PAYMENT_METHOD)).alias("payment_method"),
        F.coalesce(F.col("delivery_status"), F.lit(NO_DELIVERY_STATUS)).alias("delivery_status"),
        "delivery_delay_days",
        F.coalesce(F.col("is_late"), F.lit(False)).alias("is_late"),
    )


def customer_order_stats(spark: SparkSession, cur: dict[str, DataFrame]) -> DataFrame:
    """Per master customer, completed orders only, money in the reference
    currency.  order_id is unique in the curated orders (keyed upsert, tested
    by T1), and the joins are many-to-one, so count(*) = count(DISTINCT)."""
    o = stg_orders(cur).where(~F.col("order_status").isin(*NOT_COMPLETED))
    c = joined_side(cur, "customers", stg_customers(cur).select("customer_id", "master_customer_id"))
    fx = F.broadcast(stg_currency_rates(spark))  # three rows
    j = o.join(c, "customer_id", "inner").join(fx, "currency", "inner")
    return j.groupBy("master_customer_id").agg(
        F.max("order_date").alias("last_order_at"),
        F.min("order_date").alias("first_order_at"),
        F.count("order_id").alias("order_count"),
        F.sum(F.col("total_amount") * F.col("rate_to_reference")).alias("monetary_value"),
    )


def product_sales_stats(cur: dict[str, DataFrame], as_of: str) -> DataFrame:
    """Per product, completed orders only; units of the last 90 days."""
    o = orders_enriched(cur).where(~F.col("order_status").isin(*NOT_COMPLETED)).select("order_id", "order_date")
    since = F.date_sub(F.lit(as_of).cast("date"), RECENT_DAYS)
    # by order first: the exchange by product then serves the catalogue and the grouping
    j = stg_order_lines(cur).select("order_id", "product_id", "quantity", "line_total").join(
        joined_side(cur, "orders", o), "order_id", "inner")
    cost = joined_side(cur, "products", stg_products(cur).select("product_id", "unit_cost"))
    j = j.join(cost, "product_id", "inner").withColumn(
        "line_margin", F.col("line_total") - F.col("quantity") * F.col("unit_cost"))
    return j.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("line_total").alias("revenue"),
        F.sum("line_margin").alias("margin"),
        F.count_distinct("order_id").alias("order_count"),
        F.max("order_date").alias("last_sale_at"),
        F.sum(F.when(F.col("order_date") >= since, F.col("quantity")).otherwise(F.lit(0))).alias("units_last_90d"),
    )


# ----------------------------------------------------------------------------- dimensions
def dim_date(spark: SparkSession, start: str | None = None, end: str | None = None,
             orders: DataFrame | None = None) -> DataFrame:
    """Calendar.  Bounds are given, or derived from the orders (1 January of
    the first order year to 31 December of the last).  Size is bounded by the
    calendar span (one row per day), not by the data."""
    if start and end:
        bounds = spark.range(1).select(F.lit(start).cast("date").alias("s"), F.lit(end).cast("date").alias("e"))
    else:
        bounds = orders.agg(
            F.make_date(F.year(F.min("order_date")), F.lit(1), F.lit(1)).alias("s"),
            F.make_date(F.year(F.max("order_date")), F.lit(12), F.lit(31)).alias("e"),
        )
    days = bounds.select(F.explode(F.sequence("s", "e", F.expr("INTERVAL 1 DAY"))).alias("date"))
    dow = F.dayofweek("date")  # 1 = Sunday
    iso = F.when(dow == 1, F.lit(7)).otherwise(dow - 1)
    return days.select(
        date_key("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        year_month("date").alias("year_month"),
        F.dayofmonth("date").alias("day"),
        iso.alias("day_of_week"),
        iso.isin(6, 7).alias("is_weekend"),
    )


def snap_customers(cur: dict[str, DataFrame], run_ts: str, previous: DataFrame | None = None) -> DataFrame:
    return snapshot_check(previous, stg_customers(cur), "customer_id", CUSTOMER_CHECK_COLS, run_ts)


def snap_products(cur: dict[str, DataFrame], previous: DataFrame | None = None) -> DataFrame:
    return snapshot_timestamp(previous, stg_products(cur), "product_id", "updated_at")


DIM_CUSTOMER_COLS = [
    "customer_id", "master_customer_id", "is_duplicate_account", "gender", "birth_year", "registration_date",
    "country_code", "city", "customer_segment", "preferred_payment_method", "loyalty_tier", "account_status",
]
DIM_PRODUCT_COLS = [
    "product_id", "sku", "product_name", "category_id", "category_name", "subcategory_name", "brand", "seller_id",
    "unit_cost", "unit_price", "is_perishable", "product_status", "dq_flag",
]


def dim_customer(snapshot: DataFrame) -> DataFrame:
    """Customer versions plus the unknown member (-1).  Identifiers are text
    here, as the unknown member's are."""
    snap = snapshot.withColumn("customer_id", F.col("customer_id").cast("string")).withColumn(
        "master_customer_id", F.col("master_customer_id").cast("string"))
    dim = dimension_view(snap, "customer_id", "customer_key", DIM_CUSTOMER_COLS)
    unknown = dim.sparkSession.range(1).select(
        F.lit("-1").alias("customer_key"),
        F.lit("UNKNOWN").alias("customer_id"),
        F.lit("UNKNOWN").alias("master_customer_id"),
        F.lit(False).alias("is_duplicate_account"),
        F.lit(None).cast("string").alias("gender"),
        F.lit(None).cast("int").alias("birth_year"),
        F.lit(None).cast("date").alias("registration_date"),
        F.lit(None).cast("string").alias("country_code"),
        F.lit(None).cast("string").alias("city"),
        F.lit("UNKNOWN").alias("customer_segment"),
        F.lit(None).cast("string").alias("preferred_payment_method"),
        F.lit(None).cast("string").alias("loyalty_tier"),
        F.lit(None).cast("string").alias("account_status"),
        F.lit("1900-01-01 00:00:00").cast("timestamp").alias("valid_from"),
        F.lit("9999-12-31 00:00:00").cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    return dim.unionByName(unknown)


def dim_product(snapshot: DataFrame) -> DataFrame:
    return dimension_view(snapshot, "product_id", "product_key", DIM_PRODUCT_COLS)


def dim_payment_method(cur: dict[str, DataFrame]) -> DataFrame:
    methods = stg_payments(cur).select("payment_method").union(
        stg_payments(cur).sparkSession.range(1).select(F.lit(NO_PAYMENT_METHOD).alias("payment_method"))
    ).distinct()
    m = F.col("payment_method")
    group = (
        F.when(m.isin(*MOBILE_MONEY_METHODS), F.lit("MOBILE_MONEY"))
        .when(m == "CARD", F.lit("CARD"))
        .when(m == "COD", F.lit("CASH_ON_DELIVERY"))
        .when(m == "BANK_TRANSFER", F.lit("BANK"))
        .otherwise(F.lit("NO_PAYMENT"))
    )
    return methods.select(F.md5(m).alias("payment_method_key"), m, group.alias("payment_group"))


def dim_delivery_status(cur: dict[str, DataFrame]) -> DataFrame:
    statuses = stg_deliveries(cur).select("delivery_status").union(
        stg_deliveries(cur).sparkSession.range(1).select(F.lit(NO_DELIVERY_STATUS).alias("delivery_status"))
    ).distinct()
    s = F.col("delivery_status")
    return statuses.select(
        F.md5(s).alias("delivery_status_key"), s,
        s.isin(*FINAL_DELIVERY_STATUSES).alias("is_final"),
        (s == "DELIVERED").alias("is_successful"),
    )


# ----------------------------------------------------------------------------- fact
def fact_order_line(cur: dict[str, DataFrame], dim_cust: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """One row per order line; customer and product versions as of the order
    date (half-open intervals), unknown customer -> '-1'."""
    # heavy keys from the stored columns, not from the joined rows: a line's customer is its order's
    buyers = heavy_keys(cur["orders"].select(F.col("customer_id").cast("string").alias("_cust")), ["_cust"])
    sold = heavy_keys(cur["order_lines"], ["product_id"])
    # the customer version is a fact of the order, the current cost one of the product: a line is shuffled
    # twice, by its order and by its product
    buyer = asof_ordered(cur["orders"].select("order_id", F.col("customer_id").cast("string").alias("_cust"), "order_date"),
                         dim_cust.select("customer_key", "customer_id", "valid_from", "valid_to"),
                         "_cust", "customer_id", "order_date", how="left", prefix="c_", heavy=buyers, take=["customer_key"])
    # a key that is a digest goes with the lines as its bytes, any other as it is
    digest = F.unhex("c_customer_key")
    is_digest = F.coalesce(F.lower(F.hex(digest)) == F.col("c_customer_key"), F.lit(False))
    buyer = buyer.select("order_id", F.when(is_digest, digest).alias("_digest"),
                         F.when(~is_digest, F.col("c_customer_key")).alias("_key"))
    # what the fact does not have stays behind: nested rows are not pruned
    o = orders_enriched(cur).drop("customer_id", "zone", "delivery_delay_days").join(joined_side(cur, "orders", buyer), "order_id")
    cost = joined_side(cur, "products", stg_products(cur).select("product_id", "unit_cost"))
    versions = dim_prod.select("product_key", "product_id", "valid_from", "valid_to").join(cost, "product_id")
    j = stg_order_lines(cur).drop("order_year_month", "product_sku").join(joined_side(cur, "orders", o), "order_id", "inner")
    j = asof_ordered(j, versions, "product_id", "product_id", "order_date", how="inner", prefix="p_", heavy=sold,
                     take=["product_key", "unit_cost"])
    line_cost = F.col("quantity") * F.col("p_unit_cost")
    j = j.withColumns({"line_cost": line_cost, "line_margin": F.col("line_total") - line_cost})
    # one row per distinct status value; their size is known only once the
    # data is read, so AQE measures them and broadcasts them at run time
    pm = dim_payment_method(cur).select("payment_method", "payment_method_key")
    ds = dim_delivery_status(cur).select("delivery_status", "delivery_status_key")
    j = j.join(pm, "payment_method", "inner").join(ds, "delivery_status", "inner")
    return j.select(
        "order_line_id", "order_id",
        F.coalesce(F.lower(F.hex("_digest")), F.col("_key"), F.lit("-1")).alias("customer_key"),
        F.col("p_product_key").alias("product_key"),
        date_key("order_date").alias("order_date_key"),
        "payment_method_key", "delivery_status_key", "country_code", "currency", "channel", "order_status",
        "is_partial_payment", "is_late", "seller_id", "quantity", "unit_price", "line_discount", "line_total",
        "line_cost", "line_margin",
    )


# ----------------------------------------------------------------------------- marts
def mart_customer_rfm(stats: DataFrame, as_of: str) -> DataFrame:
    """Quintile scores (5 = best), code and first-match segment.  Ties are
    broken by master_customer_id; nulls sort last ascending."""
    base = stats.select(
        "master_customer_id", "last_order_at", "order_count", "monetary_value",
        F.datediff(F.lit(as_of).cast("date"), F.to_date("last_order_at")).alias("recency_days"),
    )
    mid = "master_customer_id"
    s = cut_ntiles(base, 5, {"_r": ["recency_days", mid], "f_score": ["order_count", "monetary_value", mid],
                             "m_score": ["monetary_value", mid]})
    s = s.withColumn("r_score", (F.lit(6) - F.col("_r")).cast("int")).drop("_r")
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    segment = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), F.lit("CHAMPIONS"))
        .when((r >= 3) & (f >= 3), F.lit("LOYAL"))
        .when((r >= 4) & (f <= 2), F.lit("NEW_OR_PROMISING"))
        .when((r <= 2) & (f >= 3), F.lit("AT_RISK"))
        .when((r <= 2) & (f <= 2) & (m <= 2), F.lit("LOST"))
        .otherwise(F.lit("NEED_ATTENTION"))
    )
    return s.select(
        "master_customer_id", "last_order_at", "recency_days", "order_count",
        F.round("monetary_value", 2).alias("monetary_value"),
        "r_score", "f_score", "m_score",
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm_code"),
        segment.alias("rfm_segment"),
    )


def mart_product_rotation(dim_prod: DataFrame, stats: DataFrame, as_of: str,
                          n_partitions: int | None = None) -> DataFrame:
    """Current products with completed sales: running revenue share by revenue
    desc (then product id), ABC at 80 % / 95 % compared exactly in decimals,
    rotation status (DORMANT is tested before SLOW)."""
    # both sides lie by product: no broadcast of a catalogue for the size of its files
    p = dim_prod.where(F.col("is_current")).select("product_id", "product_name", "category_name", "is_perishable").hint("merge")
    j = p.join(stats, "product_id", "inner").withColumn(
        "days_since_last_sale", F.datediff(F.lit(as_of).cast("date"), F.to_date("last_sale_at")))
    order = [F.col("revenue").desc_nulls_first(), F.col("product_id").asc()]
    j = global_running_sum(j, "revenue", order, "_running", total_col="_total", n=n_partitions)
    share = F.try_divide(F.col("_running").cast("double"), F.col("_total").cast("double"))
    abc = (
        F.when(F.col("_running") <= dec(ABC_A_SHARE, 4, 2) * F.col("_total"), F.lit("A"))
        .when(F.col("_running") <= dec(ABC_B_SHARE, 4, 2) * F.col("_total"), F.lit("B"))
        .otherwise(F.lit("C"))
    )
    rotation = (
        F.when(F.col("days_since_last_sale") > DORMANT_DAYS, F.lit("DORMANT"))
        .when(F.col("units_last_90d") < SLOW_UNITS_90D, F.lit("SLOW"))
        .otherwise(F.lit("ACTIVE"))
    )
    return j.select(
        "product_id", "product_name", "category_name", "is_perishable", "units_sold", "revenue", "margin",
        "order_count", "last_sale_at", "units_last_90d", "days_since_last_sale",
        share.alias("cumulative_revenue_share"), abc.alias("abc_class"), rotation.alias("rotation_status"),
    )


def return_rate_lines(cur: dict[str, DataFrame], min_month: str | None = None,
                      months: list[str] | None = None) -> DataFrame:
    """Lines of orders that count for the return rate.  With ``min_month``
    ('yyyy-MM') or a list of ``months``, stored orders and lines are filtered on
    their partition column first, so only those months are read (a line
    carries its order's month)."""
    month = F.col("order_year_month")
    for wanted in ([month >= F.lit(min_month)] if min_month is not None else []) + ([month.isin(months)] if months is not None else []):
        cur = Part(cur, {t: cur[t].where(wanted) for t in ("orders", "order_lines")}, RETURN_RATE_SOURCES)
    le = stg_order_lines(cur).select("order_id", "product_id", "line_total")
    o = orders_enriched(cur).where(~F.col("order_status").isin(*NOT_IN_RETURN_RATE)).select(
        "order_id", "order_date", "country_code", "order_status")
    p = joined_side(cur, "products", stg_products(cur).select("product_id", "category_name"))
    # by product first: the exchange by order then serves the join and the grouping by order
    return le.join(p, "product_id", "inner").join(joined_side(cur, "orders", o), "order_id", "inner").withColumn(
        "order_year_month", year_month("order_date"))


def mart_category_return_rate(cur: dict[str, DataFrame], min_month: str | None = None,
                              months: list[str] | None = None) -> DataFrame:
    """Distinct orders, returned orders, rate, revenue per month, country and
    category.  Lines -> one row per (group, order) -> one row per group."""
    j = return_rate_lines(cur, min_month, months)
    keys = ["order_year_month", "country_code", "category_name"]
    per_order = j.groupBy(*keys, "order_id").agg(
        F.sum("line_total").alias("_rev"),
        F.max((F.col("order_status") == "RETURNED").cast("int")).alias("_ret"),
    )
    g = per_order.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("orders_count"),
        F.sum("_ret").alias("returned_orders_count"),
        F.sum("_rev").alias("gross_revenue"),
        F.sum(F.when(F.col("_ret") == 1, F.col("_rev"))).alias("returned_revenue"),
    )
    return g.select(
        md5_key(*keys).alias("row_key"),
        *keys,
        "orders_count",
        F.col("returned_orders_count").cast("bigint").alias("returned_orders_count"),
        F.round(F.lit(100).cast("decimal(3,0)") * F.col("returned_orders_count").cast("decimal(20,0)")
                / F.col("orders_count").cast("decimal(20,0)"), 2).alias("return_rate_pct"),
        "gross_revenue",
        "returned_revenue",
    )


def return_rate_high_water(existing: DataFrame) -> DataFrame:
    """One row: the month before the newest stored month ('yyyy-MM')."""
    return existing.agg(
        F.date_format(F.add_months(F.to_date(F.max("order_year_month"), "yyyy-MM"), -1), "yyyy-MM").alias(
            "_min_month")
    )


def mart_category_return_rate_incremental(cur: dict[str, DataFrame], existing: DataFrame | None) -> DataFrame:
    """First run: full build.  Later runs: recompute months from the one
    before the newest stored month and replace by row_key (groups that
    vanish from the recomputed months stay)."""
    if existing is None:
        return mart_category_return_rate(cur)
    # the high-water mark is one scalar; as a literal it prunes partitions
    row = return_rate_high_water(existing).first()
    if row is None or row["_min_month"] is None:
        return mart_category_return_rate(cur)
    fresh = mart_category_return_rate(cur, row["_min_month"])
    return upsert_frames(existing, fresh, ["row_key"], check_unique=False)


RETURN_RATE_SOURCES = ["orders", "order_lines", "products", "payments", "deliveries"]


def changed_months(logs: dict[str, ChangeLog], since: dict[str, int]) -> list[str]:
    """Months whose return rate may differ from the one built at versions ``since``.

    From the change logs alone: the months of orders and lines that came, went or
    changed (old and new values), and of the orders behind changed products,
    payments and deliveries.  The result is a list of calendar months."""
    def changes(t):
        now = logs[t].latest_version()
        return None if now is None or now == since[t] else logs[t].changes(since[t], now)

    parts = []
    for t in RETURN_RATE_SOURCES:
        rows = changes(t)
        if rows is None:
            continue
        if t in ("orders", "order_lines"):
            parts.append(rows.select("order_year_month"))
        elif t == "products":
            touched = rows.select("product_id").distinct()
            parts.append(logs["order_lines"].current().join(touched, "product_id", "left_semi").select("order_year_month"))
        else:
            touched = rows.select("order_id").distinct()
            parts.append(logs["orders"].current().join(touched, "order_id", "left_semi").select("order_year_month"))
    if not parts:
        return []
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return sorted(r[0] for r in every.where("order_year_month IS NOT NULL").distinct().collect())


def mart_category_return_rate_from_changes(cur: dict[str, DataFrame], stored: DataFrame, months: list[str]) -> DataFrame:
    """The stored mart with the given months computed anew; groups that left a
    month go, so the result is that of a full build."""
    if not months:
        return stored
    kept = stored.where(~F.col("order_year_month").isin(months))
    return kept.unionByName(mart_category_return_rate(cur, months=months))
