"""Structural checks: row counts and column counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trueledger.functions.finance import FAIL, PASS, REVIEW, status_exact
from trueledger.sources.tables import column_metadata, observed_columns, row_counts

# Largest count difference that is still a minor one.
COUNT_TOLERANCE = {
    "gl_transactions": 1000,
    "invoices": 1000,
    "budget_actual": 100,
    "vendors": 10,
    "cost_centers": 10,
    "chart_of_accounts": 10,
}


def expected_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Known row counts as a relation for the checks below."""
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")


def _beside(actual: DataFrame, expected: DataFrame) -> DataFrame:
    return actual.join(
        expected.select("table_name", F.col("row_count").alias("expected_count")), "table_name", "full_outer"
    )


def row_count_parity(frames: dict[str, DataFrame], expected: DataFrame, tolerance: dict[str, int] | None = None) -> DataFrame:
    """Row count of every table against the expected one: exact, nearly, or to be reviewed."""
    tolerance = COUNT_TOLERANCE if tolerance is None else tolerance
    allowed = F.create_map(*[F.lit(x) for pair in tolerance.items() for x in pair])
    counts = _beside(row_counts(frames), expected)
    return counts.select(
        "table_name",
        "row_count",
        "expected_count",
        status_exact(
            F.col("row_count"), F.col("expected_count"), F.coalesce(F.try_element_at(allowed, F.col("table_name")), F.lit(0))
        ).alias("status"),
    ).orderBy("table_name")


def strict_row_count(frames: dict[str, DataFrame], expected: DataFrame) -> DataFrame:
    """PASS only when the counts are equal."""
    return _beside(row_counts(frames), expected).select(
        "table_name",
        "row_count",
        "expected_count",
        F.when(F.col("row_count") == F.col("expected_count"), PASS).otherwise(FAIL).alias("status"),
    )


def dataset_total(frames: dict[str, DataFrame], expected: DataFrame, minimum: int) -> DataFrame:
    """All rows of all tables together, against the expected total and a required minimum."""
    both = _beside(row_counts(frames), expected)
    total = F.coalesce(F.sum("row_count"), F.lit(0))
    return both.agg(total.alias("total_rows"), F.sum("expected_count").alias("expected_rows")).select(
        "total_rows", "expected_rows", F.when(F.col("total_rows") >= minimum, PASS).otherwise(REVIEW).alias("status")
    )


def column_counts(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    return (
        column_metadata(spark, frames)
        .groupBy("table_name")
        .agg(F.count(F.lit(1)).alias("column_count"))
        .orderBy("table_name")
    )


def populated_columns(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """Columns per table, and how many of them hold any value at all."""
    return (
        observed_columns(spark, frames)
        .groupBy("table_name")
        .agg(F.count(F.lit(1)).alias("column_count"), F.count_if(F.col("filled_values") > 0).alias("populated_columns"))
    )


def count_variance_alerts(frames: dict[str, DataFrame], expected: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Tables whose count is off by more than ``tolerance`` of the expected count."""
    gap = F.abs(F.coalesce("row_count", F.lit(0)) - F.col("expected_count"))
    variance = F.when(
        F.col("expected_count") > 0, F.round(gap.cast("decimal(20,0)") / F.col("expected_count"), 6)
    ).cast("decimal(18,6)")
    return (
        _beside(row_counts(frames), expected)
        .where(gap.cast("decimal(20,0)") > F.col("expected_count") * F.lit(str(tolerance)).cast("decimal(10,6)"))
        .select("table_name", "row_count", "expected_count", variance.alias("variance"), F.lit("High").alias("severity"))
    )
