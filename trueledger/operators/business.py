"""Business-rule checks on ledger, budget and invoices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trueledger.functions.finance import FAIL, PASS, REVIEW, ratio, safe_percent, scaled, status_below, variance_band

MILLION = 1_000_000


def gl_balance(gl: DataFrame, passing: int = 100, minor: int = 10_000) -> DataFrame:
    """Do debits equal credits, over the whole ledger."""
    sums = gl.agg(
        F.sum("debit_amount").cast("decimal(28,2)").alias("total_debits"),
        F.sum("credit_amount").cast("decimal(28,2)").alias("total_credits"),
    )
    gap = F.abs(F.col("total_debits") - F.col("total_credits")).cast("decimal(28,2)")
    return sums.withColumn("difference", gap).withColumn("status", status_below(F.col("difference"), passing, minor))


def balance_report(balance: DataFrame) -> DataFrame:
    """The balance check with its numbers formatted for reading."""
    shown = ["total_debits", "total_credits", "difference"]
    return balance.select(*[F.format_number(c, 2).alias(c) for c in shown], "status")


def balance_by_period(gl: DataFrame, latest: int = 12) -> DataFrame:
    """Debits, credits and net of the latest periods."""
    return (
        gl.groupBy("fiscal_year", "fiscal_period")
        .agg(
            F.sum("debit_amount").cast("decimal(28,2)").alias("total_debits"),
            F.sum("credit_amount").cast("decimal(28,2)").alias("total_credits"),
        )
        .withColumn("net_difference", (F.col("total_debits") - F.col("total_credits")).cast("decimal(28,2)"))
        .orderBy(F.desc("fiscal_year"), F.desc("fiscal_period"))
        .limit(latest)
    )


def net_by_year(gl: DataFrame) -> DataFrame:
    net = F.sum("debit_amount") - F.sum("credit_amount")
    return gl.groupBy("fiscal_year").agg(net.cast("decimal(28,2)").alias("net_balance")).orderBy("fiscal_year")


def date_coverage(gl: DataFrame, first_year: int, last_year: int, min_days: int = 1000) -> DataFrame:
    """First and last day, span and fiscal years; PASS inside the year window and long enough."""
    seen = gl.agg(
        F.min("transaction_date").alias("earliest_date"),
        F.max("transaction_date").alias("latest_date"),
        F.countDistinct("fiscal_year").alias("fiscal_years"),
    ).withColumn("days_span", F.datediff("latest_date", "earliest_date"))
    good = (
        (F.year("earliest_date") >= first_year) & (F.year("latest_date") <= last_year) & (F.col("days_span") > min_days)
    )
    return seen.withColumn("status", F.when(good, PASS).otherwise(REVIEW))


def recomputed_variance() -> Column:
    return (F.col("actual_amount") - F.col("budget_amount")).cast("decimal(18,2)")


# The three row rules as predicates; NULL amounts break the variance rule.
WRONG_VARIANCE = "NOT coalesce(abs(variance_amount - (actual_amount - budget_amount)) < 0.01, false)"
PAID_BUT_OWING = "status = 'Paid' AND outstanding_amount > 0"
OPEN_BUT_PAID = "status = 'Open' AND paid_amount > 0"


def variance_check(budget: DataFrame) -> DataFrame:
    """Stored variance beside the recomputed one, row by row."""
    return budget.select(
        "budget_id",
        "budget_amount",
        "actual_amount",
        "variance_amount",
        "variance_percent",
        recomputed_variance().alias("calculated_variance"),
        safe_percent(recomputed_variance(), F.col("budget_amount")).alias("calculated_percent"),
        F.when(F.expr(WRONG_VARIANCE), FAIL).otherwise(PASS).alias("status"),
    )


def status_rules(invoices: DataFrame) -> DataFrame:
    """Amounts per status, and how many invoices break the rule of their status."""
    averages = [
        ratio(F.sum(c), F.count(c)).alias(name)
        for c, name in (
            ("invoice_amount", "avg_invoice"),
            ("paid_amount", "avg_paid"),
            ("outstanding_amount", "avg_outstanding"),
        )
    ]
    return invoices.groupBy("status").agg(
        F.count(F.lit(1)).alias("invoice_count"),
        *averages,
        F.count_if(F.expr(PAID_BUT_OWING)).alias("invalid_paid"),
        F.count_if(F.expr(OPEN_BUT_PAID)).alias("invalid_open"),
    )


def _share(n: str) -> Column:
    """Percent of the total, over rows that are already one per category."""
    total = F.sum(n).over(Window.partitionBy())
    return F.round(F.col(n).cast("decimal(20,0)") * 100 / total, 2).cast("decimal(5,2)")


def status_distribution(invoices: DataFrame) -> DataFrame:
    per_status = invoices.groupBy("status").agg(
        F.count(F.lit(1)).alias("invoice_count"),
        scaled(F.sum("invoice_amount"), MILLION).alias("total_amount_m"),
        scaled(F.sum("outstanding_amount"), MILLION).alias("outstanding_m"),
        ratio(F.sum("invoice_amount"), F.count("invoice_amount")).alias("avg_invoice"),
    )
    return per_status.withColumn("percentage", _share("invoice_count")).orderBy(F.desc("invoice_count"), "status")


def variance_distribution(budget: DataFrame, bands=None) -> DataFrame:
    per_band = budget.groupBy(variance_band(F.col("variance_percent"), bands).alias("variance_category")).agg(
        F.count(F.lit(1)).alias("record_count"),
        ratio(F.sum("variance_percent"), F.count("variance_percent")).alias("avg_variance_pct"),
    )
    return per_band.withColumn("percentage", _share("record_count")).orderBy(F.desc("avg_variance_pct"), "variance_category")
