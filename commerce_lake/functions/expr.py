"""Column-expression helpers.  All of them are built-in Spark expressions, so
they stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def typed(df: DataFrame, types: dict[str, str]) -> list[Column]:
    """Projection list that converts text columns to their target types.

    ``try_cast`` turns malformed text into null instead of failing the job
    (Spark 4 runs in ANSI mode, where a plain cast raises)."""
    out = []
    for c in df.columns:
        if c in types:
            out.append(F.expr(f"try_cast(`{c}` AS {types[c]})").alias(c))
        else:
            out.append(F.col(c))
    return out


def dec(value: str, precision: int = 10, scale: int = 2) -> Column:
    """Exact decimal literal (a Python float literal would compare as double)."""
    return F.lit(value).cast(f"decimal({precision},{scale})")


def first_match(*cases: tuple[Column, str]) -> Column:
    """Ordered CASE without ELSE: the first true condition names the reason,
    no match gives null (= accepted)."""
    expr = None
    for cond, label in cases:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def salted_sha256(col: str, salt: str) -> Column:
    """Salted SHA-256 of a column; null stays null, so missing e-mails do not
    all share the hash of the salt."""
    return F.when(F.col(col).isNotNull(), F.sha2(F.concat_ws("|", F.lit(salt), F.col(col).cast("string")), 256))


def md5_key(*parts: Column | str) -> Column:
    """md5 of '|'-joined text; null in gives null out (like SQL ``||``)."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    joined = []
    for i, c in enumerate(cols):
        if i:
            joined.append(F.lit("|"))
        joined.append(c.cast("string"))
    return F.md5(F.concat(*joined))


def year_month(col: str | Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def date_key(col: str | Column) -> Column:
    return F.date_format(col, "yyyyMMdd").cast("int")


def floor_days(later: str | Column, earlier: str | Column) -> Column:
    """Whole elapsed days of a timestamp difference, floored."""
    return F.floor((F.unix_micros(F.col(later) if isinstance(later, str) else later)
                    - F.unix_micros(F.col(earlier) if isinstance(earlier, str) else earlier)) / F.lit(86_400_000_000))
