"""Declarative data-quality checks compiled to Spark aggregates.

Expectation suites (Q1-Q11): every not-null / in-set / between / regex rule
of one table is one column of a *single* aggregate over that table; each
uniqueness rule is one ``groupBy`` on its column.  The one-row results are
turned into one row per rule with ``stack``.

Relational tests (T1-T9): the 60 generic tests are one declarative list
(unique, not_null, accepted_values, relationships); per model the null and
accepted-values counts share one aggregate, uniqueness is a ``groupBy``,
relationships are anti joins, and the five singular tests compare one-row
aggregates.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.plans import warehouse as W
from commerce_lake.plans.curated import CuratedZone, joined_side
from commerce_lake.schemas import (
    CATEGORIES,
    CHANNELS,
    COUNTRIES,
    CURRENCIES,
    CUSTOMER_SEGMENTS,
    DELIVERY_STATUSES,
    GENDERS,
    ORDER_STATUSES,
    PAYMENT_METHODS,
    PAYMENT_STATUSES,
    RFM_SEGMENTS,
)


@dataclass(frozen=True)
class Expect:
    kind: str  # not_null | unique | in_set | between | regex
    column: str
    value_set: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    strict_min: bool = False
    regex: str | None = None
    mostly: float | None = None

    @property
    def name(self) -> str:
        return {
            "not_null": "expect_column_values_to_not_be_null",
            "unique": "expect_column_values_to_be_unique",
            "in_set": "expect_column_values_to_be_in_set",
            "between": "expect_column_values_to_be_between",
            "regex": "expect_column_values_to_match_regex",
        }[self.kind]


# FIXED VALUES: the four suites (rule, column, parameters), in source order.
SUITES: dict[str, list[Expect]] = {
    "orders": [
        Expect("not_null", "order_id"),
        Expect("unique", "order_id"),
        Expect("not_null", "customer_id"),
        Expect("in_set", "order_status", tuple(ORDER_STATUSES)),
        Expect("in_set", "currency", ("XOF", "GHS", "NGN")),
        Expect("between", "total_amount", min_value=0),
        Expect("between", "subtotal_amount", min_value=0, mostly=0.999),
        Expect("not_null", "order_date"),
        Expect("in_set", "channel", tuple(CHANNELS)),
    ],
    "customers": [
        Expect("not_null", "customer_id"),
        Expect("not_null", "master_customer_id"),
        Expect("not_null", "email_hash", mostly=0.95),
        Expect("regex", "email_hash", regex=r"^[0-9a-f]{64}$"),
        Expect("between", "birth_year", min_value=1930, max_value=2012, mostly=0.99),
        Expect("in_set", "customer_segment", tuple(CUSTOMER_SEGMENTS)),
    ],
    "products": [
        Expect("not_null", "product_id"),
        Expect("unique", "product_id"),
        Expect("between", "unit_price", min_value=0, strict_min=True, mostly=0.98),
        Expect("between", "unit_cost", min_value=0),
        Expect("not_null", "category_name"),
    ],
    "payments": [
        Expect("not_null", "payment_id"),
        Expect("unique", "payment_id"),
        Expect("not_null", "order_id"),
        Expect("in_set", "payment_status", tuple(PAYMENT_STATUSES)),
        Expect("between", "payment_amount", min_value=0),
    ],
}


def _unexpected(e: Expect) -> Column:
    c = F.col(e.column)
    if e.kind == "not_null":
        return F.count_if(c.isNull())
    if e.kind == "in_set":
        return F.count_if(c.isNotNull() & ~c.isin(*e.value_set))
    if e.kind == "between":
        bad = F.lit(False)
        if e.min_value is not None:
            bad = bad | ((c <= F.lit(e.min_value)) if e.strict_min else (c < F.lit(e.min_value)))
        if e.max_value is not None:
            bad = bad | (c > F.lit(e.max_value))
        return F.count_if(c.isNotNull() & bad)
    if e.kind == "regex":
        return F.count_if(c.isNotNull() & ~c.cast("string").rlike(e.regex))
    raise ValueError(e.kind)


def _mostly_milli(e: Expect) -> int | None:
    return None if e.mostly is None else int(round(e.mostly * 1000))


def run_suite(table: str, df: DataFrame, rules: list[Expect]) -> DataFrame:
    """One row per rule: table, expectation, column, element_count,
    unexpected_count, unexpected_percent, success.  ``mostly`` compares the
    passing share over all rows (not-null) or non-null rows (others); an
    empty base passes."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, e in enumerate(rules):
        if e.kind != "unique":
            aggs.append(_unexpected(e).alias(f"_u{i}"))
            aggs.append(F.count(e.column).alias(f"_n{i}"))
    row = df.agg(*aggs)
    for i, e in enumerate(rules):
        if e.kind == "unique":
            c = F.col(e.column)
            u = (
                df.where(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_c"))
                .agg(F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0)).alias(f"_u{i}"),
                     F.coalesce(F.sum("_c"), F.lit(0)).alias(f"_n{i}"))
            )
            row = row.crossJoin(u)  # two one-row frames
    stack = []
    for i, e in enumerate(rules):
        base = "_rows" if e.kind == "not_null" else f"_n{i}"
        mostly = _mostly_milli(e)
        stack.append(
            f"'{e.name}', '{e.column}', CAST(_u{i} AS BIGINT), CAST({base} AS BIGINT), "
            f"CAST({-1 if mostly is None else mostly} AS INT)"
        )
    expr = f"stack({len(rules)}, {', '.join(stack)}) AS (expectation, column_name, unexpected_count, base_count, mostly_milli)"
    out = row.selectExpr("_rows", expr)
    success = F.when(F.col("mostly_milli") < 0, F.col("unexpected_count") == 0).otherwise(
        (F.col("base_count") == 0)
        | ((F.col("base_count") - F.col("unexpected_count")) * 1000 >= F.col("mostly_milli") * F.col("base_count"))
    )
    return out.select(
        F.lit(table).alias("table_name"),
        "expectation",
        "column_name",
        F.col("_rows").cast("bigint").alias("element_count"),
        "unexpected_count",
        F.when(F.col("base_count") > 0,
               F.col("unexpected_count").cast("double") * F.lit(100.0) / F.col("base_count").cast("double")).alias(
            "unexpected_percent"),
        success.alias("success"),
    )


def expectation_results(cur: dict[str, DataFrame]) -> DataFrame:
    out = None
    for table, rules in SUITES.items():
        r = run_suite(table, cur[table], rules)
        out = r if out is None else out.unionByName(r)
    return out


def suite_summary(results: DataFrame) -> DataFrame:
    """Per table: rules, failed rules, overall success."""
    return results.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("expectations"),
        F.count_if(~F.col("success")).alias("failed"),
        F.bool_and("success").alias("success"),
    )


# ----------------------------------------------------------------------------- relational tests
@dataclass(frozen=True)
class Test:
    kind: str  # unique | not_null | accepted_values | relationships | singular
    model: str
    column: str = ""
    values: tuple = ()
    to: str = ""
    field: str = ""
    where: str = ""

    @property
    def test_id(self) -> str:
        if self.kind == "relationships":
            return f"relationships_{self.model}_{self.column}__{self.to}_{self.field}"
        if self.kind == "singular":
            return self.column
        return f"{self.kind}_{self.model}_{self.column}"


def _u(model, col):
    return [Test("unique", model, col), Test("not_null", model, col)]


# FIXED VALUES: the declared tests (models, columns, value lists, parents).
GENERIC_TESTS: list[Test] = [
    *_u("stg_orders", "order_id"),
    Test("not_null", "stg_orders", "customer_id"),
    Test("relationships", "stg_orders", "customer_id", to="stg_customers", field="customer_id",
         where="customer_dq_flag is null"),
    Test("accepted_values", "stg_orders", "order_status", tuple(ORDER_STATUSES)),
    Test("accepted_values", "stg_orders", "currency", tuple(CURRENCIES)),
    Test("accepted_values", "stg_orders", "country_code", tuple(COUNTRIES)),
    *_u("stg_order_lines", "order_line_id"),
    Test("relationships", "stg_order_lines", "order_id", to="stg_orders", field="order_id"),
    Test("relationships", "stg_order_lines", "product_id", to="stg_products", field="product_id"),
    *_u("stg_customers", "customer_id"),
    Test("not_null", "stg_customers", "master_customer_id"),
    Test("accepted_values", "stg_customers", "gender", tuple(GENDERS)),
    *_u("stg_products", "product_id"),
    Test("accepted_values", "stg_products", "category_name", tuple(CATEGORIES)),
    *_u("stg_payments", "payment_id"),
    Test("relationships", "stg_payments", "order_id", to="stg_orders", field="order_id"),
    Test("accepted_values", "stg_payments", "payment_status", tuple(PAYMENT_STATUSES)),
    Test("accepted_values", "stg_payments", "payment_method", tuple(PAYMENT_METHODS)),
    *_u("stg_deliveries", "delivery_id"),
    Test("relationships", "stg_deliveries", "order_id", to="stg_orders", field="order_id"),
    Test("accepted_values", "stg_deliveries", "delivery_status", tuple(DELIVERY_STATUSES)),
    *_u("dim_date", "date_key"),
    *_u("dim_customer", "customer_key"),
    Test("not_null", "dim_customer", "customer_id"),
    *_u("dim_product", "product_key"),
    *_u("dim_payment_method", "payment_method_key"),
    *_u("dim_delivery_status", "delivery_status_key"),
    *_u("fact_order_line", "order_line_id"),
    Test("relationships", "fact_order_line", "customer_key", to="dim_customer", field="customer_key"),
    Test("not_null", "fact_order_line", "product_key"),
    Test("relationships", "fact_order_line", "product_key", to="dim_product", field="product_key"),
    Test("relationships", "fact_order_line", "order_date_key", to="dim_date", field="date_key"),
    Test("relationships", "fact_order_line", "payment_method_key", to="dim_payment_method",
         field="payment_method_key"),
    Test("relationships", "fact_order_line", "delivery_status_key", to="dim_delivery_status",
         field="delivery_status_key"),
    *_u("mart_customer_rfm", "master_customer_id"),
    Test("accepted_values", "mart_customer_rfm", "r_score", (1, 2, 3, 4, 5)),
    Test("accepted_values", "mart_customer_rfm", "f_score", (1, 2, 3, 4, 5)),
    Test("accepted_values", "mart_customer_rfm", "m_score", (1, 2, 3, 4, 5)),
    Test("not_null", "mart_customer_rfm", "rfm_segment"),
    Test("accepted_values", "mart_customer_rfm", "rfm_segment", tuple(RFM_SEGMENTS)),
    *_u("mart_product_rotation", "product_id"),
    Test("accepted_values", "mart_product_rotation", "abc_class", ("A", "B", "C")),
    Test("accepted_values", "mart_product_rotation", "rotation_status", ("ACTIVE", "SLOW", "DORMANT")),
    *_u("mart_category_return_rate", "row_key"),
    Test("not_null", "mart_category_return_rate", "return_rate_pct"),
]

SINGULAR_TESTS = [
    "assert_fact_row_count_matches_staging",
    "assert_fact_total_matches_staging",
    "assert_one_current_version_per_customer",
    "assert_one_current_version_per_product",
    "assert_rfm_covers_all_buying_customers",
]


def staging(cur: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_orders": W.stg_orders(cur),
        "stg_order_lines": W.stg_order_lines(cur),
        "stg_customers": W.stg_customers(cur),
        "stg_products": W.stg_products(cur),
        "stg_payments": W.stg_payments(cur),
        "stg_deliveries": W.stg_deliveries(cur),
    }


def computed(lake) -> dict[str, Callable[[], DataFrame]]:
    """The models that are stored, each before those that read it."""
    cur = lake.cur
    return {
        "dim_date": lambda: W.dim_date(lake.spark, orders=cur["orders"]),
        "dim_customer": lambda: lake.dim_customer,
        "dim_product": lambda: lake.dim_product,
        "dim_payment_method": lambda: W.dim_payment_method(cur),
        "dim_delivery_status": lambda: W.dim_delivery_status(cur),
        "int_customer_order_stats": lake.customer_stats,
        "mart_customer_rfm": lake.rfm,
        "mart_product_rotation": lake.rotation,
        "mart_category_return_rate": lake.return_rate,
    }


def _row(test: Test, failures: Column) -> list[Column]:
    return [F.lit(test.test_id).alias("test_id"), F.lit(test.kind).alias("kind"), F.lit(test.model).alias("model"),
            F.lit(test.column).alias("column_name"), failures.cast("bigint").alias("failures")]


#: Parents that grow with the data: the curated table that has as many rows.
PARENTS = {"stg_orders": "orders", "stg_customers": "customers", "dim_customer": "customers", "stg_products": "products",
           "dim_product": "products"}


def _generic(test: Test, m: dict[str, DataFrame], cur: dict[str, DataFrame] | None = None) -> DataFrame:
    df = m[test.model]
    c = F.col(test.column)
    if test.kind == "not_null":
        return df.agg(F.count_if(c.isNull()).alias("_f")).select(*_row(test, F.col("_f")))
    if test.kind == "unique":
        dup = df.where(c.isNotNull()).groupBy(c).count().where(F.col("count") > 1)
        return dup.agg(F.count(F.lit(1)).alias("_f")).select(*_row(test, F.col("_f")))
    if test.kind == "accepted_values":
        bad = df.where(c.isNotNull() & ~c.isin(*test.values)).select(c).distinct()
        return bad.agg(F.count(F.lit(1)).alias("_f")).select(*_row(test, F.col("_f")))
    if test.kind == "relationships":
        child = df.where(c.isNotNull())
        if test.where:
            child = child.where(test.where)
        parent = m[test.to].select(F.col(test.field).alias("_pk")).where(F.col("_pk").isNotNull())
        if test.to in PARENTS:
            parent = joined_side(cur or {}, PARENTS[test.to], parent)
        # a key is moved once for the rows of a task that share it
        keys = child.groupBy(c.alias("_ck")).agg(F.count(F.lit(1)).alias("_rows"))
        orphans = keys.join(parent, F.col("_ck") == F.col("_pk"), "left_anti")
        return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("_f")).select(*_row(test, F.col("_f")))
    raise ValueError(test.kind)


def _model_counts(model: str, tests: list[Test], df: DataFrame) -> DataFrame:
    """A model's not-null and accepted-values tests: one scan each kind.  The
    rows that break a list are filtered before their distinct values are counted,
    so a row that breaks none is neither expanded nor shuffled."""
    nulls = [t for t in tests if t.kind == "not_null"]
    lists = [t for t in tests if t.kind == "accepted_values"]
    out = None
    if nulls:
        rows = ", ".join(f"'{t.test_id}', '{t.kind}', '{t.model}', '{t.column}', _f{i}" for i, t in enumerate(nulls))
        out = df.agg(*[F.count_if(F.col(t.column).isNull()).alias(f"_f{i}") for i, t in enumerate(nulls)]).selectExpr(
            f"stack({len(nulls)}, {rows}) AS (test_id, kind, model, column_name, failures)")
    if lists:
        broken = [F.when(F.col(t.column).isNotNull() & ~F.col(t.column).isin(*t.values),
                         F.struct(F.lit(t.test_id).alias("test_id"), F.col(t.column).cast("string").alias("value"))) for t in lists]
        found = (df.select(F.explode(F.filter(F.array(*broken), lambda b: b.isNotNull())).alias("b")).select("b.*").distinct()
                 .groupBy("test_id").agg(F.count(F.lit(1)).alias("failures")))
        known = df.sparkSession.createDataFrame([(t.test_id, t.kind, t.model, t.column) for t in lists],
                                                "test_id string, kind string, model string, column_name string")
        some = known.join(found, "test_id", "left").select(
            "test_id", "kind", "model", "column_name", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"))
        out = some if out is None else out.unionByName(some)
    return out


def _singular(name: str, m: dict[str, DataFrame]) -> DataFrame:
    t = Test("singular", "-", name)
    fact, lines = m["fact_order_line"], m["stg_order_lines"]
    if name == "assert_fact_row_count_matches_staging":
        a = fact.agg(F.count(F.lit(1)).alias("a")).crossJoin(lines.agg(F.count(F.lit(1)).alias("b")))
        return a.select(*_row(t, (F.col("a") != F.col("b")).cast("int")))
    if name == "assert_fact_total_matches_staging":
        a = fact.agg(F.sum("line_total").alias("a")).crossJoin(lines.agg(F.sum("line_total").alias("b")))
        return a.select(*_row(t, F.coalesce((F.abs(F.col("a") - F.col("b")) > F.lit(0.01)).cast("int"), F.lit(0))))
    if name in ("assert_one_current_version_per_customer", "assert_one_current_version_per_product"):
        dim, key = (m["dim_customer"], "customer_id") if "customer" in name else (m["dim_product"], "product_id")
        bad = dim.where(F.col("is_current")).groupBy(key).count().where(F.col("count") > 1)
        return bad.agg(F.count(F.lit(1)).alias("_f")).select(*_row(t, F.col("_f")))
    if name == "assert_rfm_covers_all_buying_customers":
        a = m["mart_customer_rfm"].agg(F.count(F.lit(1)).alias("a")).crossJoin(
            m["int_customer_order_stats"].agg(F.count(F.lit(1)).alias("b")))
        return a.select(*_row(t, (F.col("a") != F.col("b")).cast("int")))
    raise ValueError(name)


def relational_tests(lake) -> DataFrame:
    """All 65 tests.  Staging models are projections of stored tables; the
    computed ones (dimensions, fact, marts, stats) are stored once by the lake
    (or were, by the daily run), and the 65 small aggregates read them.  Over a
    curated zone the tests of one model are run and their rows stored before
    those of the next, so that only their shuffle files and plans exist."""
    m = staging(lake.cur)
    for name, build in computed(lake).items():
        m[name] = lake.stored(name, build)
    m["fact_order_line"] = lake.stored_fact()
    parts: dict[str, list[DataFrame]] = {}
    # per model, every not-null and accepted-values test is one column of a
    # single aggregate; uniqueness and relationships need their own shuffle
    by_model: dict[str, list[Test]] = {}
    for t in GENERIC_TESTS:
        if t.kind in ("not_null", "accepted_values"):
            by_model.setdefault(t.model, []).append(t)
        else:
            parts.setdefault(t.model, []).append(_generic(t, m, lake.cur))
    for model, tests in by_model.items():
        parts.setdefault(model, []).append(_model_counts(model, tests, m[model]))
    parts["singular"] = [_singular(s, m) for s in SINGULAR_TESTS]
    out = None
    for model, rows in parts.items():
        some = reduce(DataFrame.unionByName, rows)
        if isinstance(lake.cur, CuratedZone):
            some = lake.stored(f"tests_{model}", lambda s=some: s)
        out = some if out is None else out.unionByName(some)
    return out.withColumn("status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")))
