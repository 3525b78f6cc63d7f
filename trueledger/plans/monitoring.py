"""Monitoring over the sync, check, query and metering logs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trueledger.functions.finance import PASS, REVIEW, as_of_date, ratio
from trueledger.operators.statistical import discrete_percentile
from trueledger.sources.tables import union_all

# Metric, threshold (an alert above it) and severity.
ALERT_RULES = [
    ("sync_failed", "0", "Critical"),
    ("check_failed", "0", "High"),
    ("utilisation_percent", "80", "Medium"),
    ("monthly_spend", "100", "Low"),
]
METRIC = "decimal(18,2)"


def with_latency(log: DataFrame) -> DataFrame:
    """The sync log with the milliseconds from commit (``sync_start``) to copy (``sync_end``)."""
    return log.withColumn("latency_ms", F.timestamp_diff("MILLISECOND", F.col("sync_start"), F.col("sync_end")))


def sync_latency(log: DataFrame, limit_ms: int = 5 * 60_000) -> DataFrame:
    """Largest and 95th-percentile delay between commit and copy per table, and runs over the limit."""
    log = with_latency(log)
    p95 = discrete_percentile(log, ["table_name"], "latency_ms", "0.95", "p95_latency_ms")
    totals = log.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.max("latency_ms").alias("max_latency_ms"),
        F.count_if(F.col("latency_ms") > limit_ms).alias("over_limit"),
    )
    return totals.join(p95, "table_name").withColumn("status", F.when(F.col("max_latency_ms") <= limit_ms, PASS).otherwise(REVIEW))


def sync_status(log: DataFrame) -> DataFrame:
    """Last sync, its rows, worst latency and failures per table."""
    return with_latency(log).groupBy("table_name").agg(
        F.max("sync_start").alias("last_sync"),
        F.max_by("rows_synced", F.struct("sync_start", "run_id")).alias("last_rows"),
        F.max("latency_ms").alias("max_latency_ms"),
        F.count_if(F.col("error").isNotNull()).alias("failed_syncs"),
    )


def pass_rate_trend(log: DataFrame) -> DataFrame:
    """Daily pass rate per check category with its 7- and 30-day rolling rates."""
    daily = log.groupBy("category", F.col("run_ts").cast("date").alias("run_date")).agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "PASS").alias("passed")
    )
    by_day = Window.partitionBy("category").orderBy(F.unix_date("run_date"))
    rolling = lambda days: ratio(
        F.sum(F.col("passed") * 100).over(by_day.rangeBetween(1 - days, 0)), F.sum("runs").over(by_day.rangeBetween(1 - days, 0))
    )
    return daily.select(
        "category",
        "run_date",
        "runs",
        (F.col("runs") - F.col("passed")).alias("failures"),
        ratio(F.col("passed") * 100, F.col("runs")).alias("pass_rate"),
        rolling(7).alias("pass_rate_7d"),
        rolling(30).alias("pass_rate_30d"),
    )


def query_times(log: DataFrame) -> DataFrame:
    """Queries, mean and 95th-percentile seconds per user and day."""
    keyed = log.select("user_id", F.col("started_at").cast("date").alias("day"), "seconds")
    p95 = discrete_percentile(keyed, ["user_id", "day"], "seconds", "0.95", "p95_seconds")
    means = keyed.groupBy("user_id", "day").agg(
        F.count(F.lit(1)).alias("queries"), ratio(F.sum("seconds"), F.count("seconds")).alias("avg_seconds")
    )
    return means.join(p95, ["user_id", "day"])


def metered_cost(metering: DataFrame, as_of: dt.date | None = None, days: int = 7, rate: str = "2") -> DataFrame:
    """Credits per warehouse from ``days`` before ``as_of`` to the end of that day, and their cost."""
    since = F.date_sub(as_of_date(as_of), days).cast("timestamp_ntz")
    until = F.date_add(as_of_date(as_of), 1).cast("timestamp_ntz")
    return (
        metering.where((F.col("start_time") >= since) & (F.col("start_time") < until))
        .groupBy("warehouse_name")
        .agg(F.sum("credits_used").cast("decimal(28,2)").alias("total_credits"))
        .withColumn("estimated_cost", F.round(F.col("total_credits") * F.lit(rate).cast("decimal(8,2)"), 2).cast("decimal(28,2)"))
    )


def capacity_use(metering: DataFrame, target_hours: int = 200) -> DataFrame:
    """Hours with any activity per warehouse and month, against the target."""
    month = F.date_format("start_time", "yyyy-MM").alias("month")
    hours = metering.groupBy("warehouse_name", month, F.date_trunc("hour", "start_time").alias("h")).agg(
        F.sum("credits_used").alias("credits")
    )
    return (
        hours.groupBy("warehouse_name", "month")
        .agg(F.count(F.lit(1)).alias("active_hours"), F.sum("credits").cast("decimal(28,2)").alias("credits"))
        .withColumn("over_target", F.col("active_hours") > target_hours)
    )


def metrics(sync_log: DataFrame, check_log: DataFrame, metering: DataFrame, daily_capacity: str, rate: str = "2", since: dt.datetime | None = None) -> DataFrame:
    """The values alert rules look at, of everything in the logs or ``since`` a time: ``entity, metric, value``."""
    if since is not None:
        from_ = F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz")
        sync_log, check_log, metering = (log.where(F.col(c) >= from_) for log, c in ((sync_log, "sync_start"), (check_log, "run_ts"), (metering, "start_time")))
    rows = lambda df, entity, metric, value: df.select(
        F.col(entity).alias("entity"), F.lit(metric).alias("metric"), value.cast(METRIC).alias("value")
    )
    failed_syncs = sync_log.groupBy("table_name").agg(F.count("error").alias("n"))
    failed_checks = check_log.groupBy("category").agg(F.count_if(F.col("status") == REVIEW).alias("n"))
    daily = metering.groupBy("warehouse_name", F.col("start_time").cast("date").alias("day")).agg(F.sum("credits_used").alias("credits"))
    per_warehouse = daily.groupBy("warehouse_name").agg(F.max("credits").alias("busiest_day"))
    monthly = daily.groupBy("warehouse_name", F.date_format("day", "yyyy-MM").alias("month")).agg(F.sum("credits").alias("credits"))
    spend = monthly.groupBy("warehouse_name").agg(F.max("credits").alias("credits"))
    share = F.round(F.col("busiest_day").cast("decimal(20,2)") * 100 / F.lit(daily_capacity).cast("decimal(18,2)"), 2)
    return union_all(
        [
            rows(failed_syncs, "table_name", "sync_failed", F.col("n")),
            rows(failed_checks, "category", "check_failed", F.col("n")),
            rows(per_warehouse, "warehouse_name", "utilisation_percent", share),
            rows(spend, "warehouse_name", "monthly_spend", F.col("credits") * F.lit(rate).cast("decimal(8,2)")),
        ]
    )


def _rules(spark: SparkSession, rules: list[tuple[str, str, str]] | None) -> DataFrame:
    limits = spark.createDataFrame(rules or ALERT_RULES, "metric string, threshold string, severity string")
    return limits.withColumn("threshold", F.col("threshold").cast(METRIC))


def alerts(spark: SparkSession, measured: DataFrame, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Metrics above their rule's threshold."""
    return measured.join(_rules(spark, rules), "metric").where(F.col("value") > F.col("threshold")).select(
        "severity", "metric", "entity", "value", "threshold"
    )


def sync_outcomes(log: DataFrame) -> DataFrame:
    """The sync log as outcomes: ``metric, entity, at, run_id, failed``."""
    return log.select(
        F.lit("sync_failed").alias("metric"), F.col("table_name").alias("entity"), F.col("sync_start").alias("at"),
        F.col("run_id").cast("string").alias("run_id"), F.col("error").isNotNull().alias("failed"),
    )


def check_outcomes(log: DataFrame) -> DataFrame:
    """The check log as outcomes. Of a run with several rows for a check, one to be reviewed fails it."""
    runs = log.groupBy("check_id", "run_ts", "run_id").agg(F.coalesce(F.max(F.col("status") == REVIEW), F.lit(False)).alias("failed"))
    return runs.select(F.lit("check_failed").alias("metric"), F.col("check_id").alias("entity"), F.col("run_ts").alias("at"), F.col("run_id").cast("string").alias("run_id"), "failed")


def alert_states(spark: SparkSession, outcomes: DataFrame, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """When each alert was raised and cleared: ``severity, metric, entity, raised_at, last_failed_at, failures, cleared_at``.

    The first failure after a success raises an alert, the next success clears it; ``cleared_at`` is
    NULL while it is open. Outcomes of one entity at the same time are taken in order of their run.
    """
    order = Window.partitionBy("metric", "entity").orderBy("at", "run_id")
    raises = F.col("failed") & ~F.lag("failed", 1, False).over(order)
    spans = outcomes.withColumn("_raises", raises).withColumn("_span", F.sum(F.col("_raises").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    states = spans.where("_span > 0").groupBy("metric", "entity", "_span").agg(
        F.min(F.when(F.col("failed"), F.col("at"))).alias("raised_at"),
        F.max(F.when(F.col("failed"), F.col("at"))).alias("last_failed_at"),
        F.count_if("failed").alias("failures"),
        F.min(F.when(~F.col("failed"), F.col("at"))).alias("cleared_at"),
    )
    return states.join(_rules(spark, rules), "metric").select("severity", "metric", "entity", "raised_at", "last_failed_at", "failures", "cleared_at")


def open_alerts(states: DataFrame) -> DataFrame:
    """The alerts that nothing has cleared yet."""
    return states.where(F.col("cleared_at").isNull()).drop("cleared_at")
