"""Integrity checks: keys, references and NULLs.

Reference checks sum the child per key first. A key holding a large share of the child then weighs
as much as any other in the join, and NULL keys are one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trueledger.functions.finance import PASS, REVIEW, status_below
from trueledger.sources.tables import union_all


def _keyed(parent: DataFrame, parent_keys: list[str], child_keys: list[str]) -> DataFrame:
    return parent.select(*[F.col(p).alias(c) for p, c in zip(parent_keys, child_keys)])


def orphan_keys(child: DataFrame, keys: list[str], parent: DataFrame, parent_keys: list[str] | None = None) -> DataFrame:
    """Key values of the child without a parent row, with the child rows that carry them."""
    per_key = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return per_key.join(_keyed(parent, parent_keys or keys, keys), keys, "left_anti")


def orphan_rows(child: DataFrame, keys: list[str], parent: DataFrame, parent_keys: list[str] | None = None) -> DataFrame:
    """The child rows themselves. A NULL key has no parent, so it counts."""
    return child.join(_keyed(parent, parent_keys or keys, keys), keys, "left_anti")


def foreign_key_check(name: str, child: DataFrame, keys: list[str], parent: DataFrame, parent_keys: list[str] | None = None, minor: int = 100) -> DataFrame:
    """Orphan count of one reference: none, fewer than ``minor``, or to be reviewed."""
    return (
        orphan_keys(child, keys, parent, parent_keys)
        .agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys"))
        .select(
            F.lit(name).alias("reference"),
            "orphan_rows",
            "orphan_keys",
            status_below(F.col("orphan_rows"), 1, minor).alias("status"),
        )
    )


def key_coverage(name: str, child: DataFrame, key: str, parent: DataFrame, minor: int = 10) -> DataFrame:
    """Distinct keys in use, how many of them the parent knows, and the gap."""
    used = child.select(key).distinct()
    known = parent.select(key).distinct().withColumn("known", F.lit(1))
    return (
        used.join(known, key, "left")
        .agg(F.count(key).alias("used_keys"), F.count("known").alias("valid_keys"))
        .withColumn("missing_keys", F.col("used_keys") - F.col("valid_keys"))
        .select(
            F.lit(name).alias("reference"),
            "used_keys",
            "valid_keys",
            "missing_keys",
            status_below(F.col("missing_keys"), 1, minor).alias("status"),
        )
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def duplicate_summary(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    return (
        duplicate_keys(df, keys)
        .agg(F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("surplus_rows"))
        .select(
            F.lit(name).alias("table_name"),
            "duplicate_keys",
            "surplus_rows",
            F.when(F.col("duplicate_keys") == 0, PASS).otherwise(REVIEW).alias("status"),
        )
    )


def critical_nulls(gl: DataFrame) -> DataFrame:
    """Ledger rows without id or account (must be none) and rows with no amount (information)."""
    return gl.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("transaction_id").isNull()).alias("null_ids"),
        F.count_if(F.col("account_number").isNull()).alias("null_accounts"),
        F.count_if((F.col("debit_amount") == 0) & (F.col("credit_amount") == 0)).alias("zero_amount_rows"),
    ).withColumn(
        "status", F.when((F.col("null_ids") == 0) & (F.col("null_accounts") == 0), PASS).otherwise(REVIEW)
    )


def null_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One row per column: total rows and NULLs, from one pass over the table."""
    counted = df.selectExpr("count(1) AS total_rows", *[f"count(`{c}`) AS `{c}`" for c in columns])
    rows = ", ".join(f"'{c}', total_rows - `{c}`" for c in columns)
    return counted.selectExpr(
        f"'{table}' AS table_name", "total_rows", f"stack({len(columns)}, {rows}) AS (column_name, null_rows)"
    ).select("table_name", "column_name", "total_rows", "null_rows")


def required_nulls(frames: dict[str, DataFrame], required: dict[str, list[str]]) -> DataFrame:
    parts = [null_counts(frames[name], name, cols) for name, cols in required.items() if name in frames]
    return union_all(parts).withColumn("status", F.when(F.col("null_rows") == 0, PASS).otherwise(REVIEW))


def any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
