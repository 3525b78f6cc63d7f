"""Monitoring by name."""

from __future__ import annotations

import datetime as dt

from trueledger.plans import monitoring as M
from trueledger.registry import query
from trueledger.registry.ctes import SPANS, cents, exact_ratio, with_views
from trueledger.sources import testviews as V
from trueledger.streaming.change_counts import change_counts

CAPACITY = "5000"


@query(
    "a11_metering",
    with_views(
        "metering",
        """SELECT warehouse_name, CAST(SUM(credits_used) AS DECIMAL(28,2)) AS total_credits, CAST(SUM(credits_used) * 2 AS DECIMAL(28,2)) AS estimated_cost
        FROM metering WHERE start_time >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY 1""",
    ),
)
def a11(spark, sf_dir):
    return M.metered_cost(V.metering(spark, sf_dir), dt.date(2024, 1, 31))


@query(
    "m02_alerts",
    with_views(
        "sync_log check_log metering",
        f""", d AS (SELECT warehouse_name, CAST(start_time AS DATE) AS day, SUM(credits_used) AS c FROM metering GROUP BY 1, 2),
        m AS (SELECT table_name AS entity, 'sync_failed' AS metric, CAST(COUNT(error) AS DECIMAL(18,2)) AS value FROM sync_log GROUP BY 1
        UNION ALL SELECT category, 'check_failed', CAST(COUNT(*) FILTER (status = 'REVIEW') AS DECIMAL(18,2)) FROM check_log GROUP BY 1
        UNION ALL SELECT warehouse_name, 'utilisation_percent', CAST({exact_ratio(f"{cents('MAX(c)')} * 100", CAPACITY)} AS DECIMAL(18,2)) FROM d GROUP BY 1
        UNION ALL SELECT warehouse_name, 'monthly_spend', CAST(MAX(c) * 2 AS DECIMAL(18,2)) FROM
          (SELECT warehouse_name, strftime(day, '%Y-%m') AS month, SUM(c) AS c FROM d GROUP BY 1, 2) GROUP BY 1),
        r AS (SELECT * FROM (VALUES ('sync_failed', 0, 'Critical'), ('check_failed', 0, 'High'), ('utilisation_percent', 80, 'Medium'), ('monthly_spend', 100, 'Low')) AS v(metric, t, severity))
        SELECT severity, metric, entity, value, CAST(t AS DECIMAL(18,2)) AS threshold FROM m JOIN r USING (metric) WHERE value > t""",
    ),
)
def m02(spark, sf_dir):
    measured = M.metrics(V.sync_log(spark, sf_dir), V.check_log(spark, sf_dir), V.metering(spark, sf_dir), CAPACITY)
    return M.alerts(spark, measured)


@query(
    "m02_alert_states",
    with_views(
        "sync_log check_log",
        f""", o AS (SELECT 'sync_failed' AS metric, table_name AS entity, sync_start AS ran_at, CAST(run_id AS VARCHAR) AS run_id, error IS NOT NULL AS failed FROM sync_log
        UNION ALL SELECT 'check_failed', check_id, run_ts, CAST(run_id AS VARCHAR), bool_or(status = 'REVIEW') FROM check_log GROUP BY check_id, run_ts, run_id), {SPANS}""",
    ),
)
def m02_states(spark, sf_dir):
    """Every alert of the logs with the time it was raised and, where a success followed, cleared."""
    outcomes = M.sync_outcomes(V.sync_log(spark, sf_dir)).unionByName(M.check_outcomes(V.check_log(spark, sf_dir)))
    return M.alert_states(spark, outcomes)


@query(
    "m03_sync_status",
    with_views(
        "sync_log",
        """SELECT table_name, MAX(sync_start) AS last_sync, arg_max(rows_synced, (sync_start, run_id)) AS last_rows, MAX(latency_ms) AS max_latency_ms,
        COUNT(error) AS failed_syncs FROM sync_log GROUP BY 1""",
    ),
)
def m03(spark, sf_dir):
    return M.sync_status(V.sync_log(spark, sf_dir))


def _rolling(days: int) -> str:
    frame = f"(PARTITION BY category ORDER BY run_date RANGE BETWEEN INTERVAL {days - 1} DAYS PRECEDING AND CURRENT ROW)"
    return exact_ratio(f"SUM(passed) OVER {frame} * 10000", f"SUM(runs) OVER {frame}")


@query(
    "m04_pass_rate_trend",
    with_views(
        "check_log",
        f""", d AS (SELECT category, CAST(run_ts AS DATE) AS run_date, COUNT(*) AS runs, COUNT(*) FILTER (status = 'PASS') AS passed FROM check_log GROUP BY 1, 2)
        SELECT category, run_date, runs, runs - passed AS failures, {exact_ratio('passed * 10000', 'runs')} AS pass_rate,
        {_rolling(7)} AS pass_rate_7d, {_rolling(30)} AS pass_rate_30d FROM d""",
    ),
)
def m04(spark, sf_dir):
    return M.pass_rate_trend(V.check_log(spark, sf_dir))


@query(
    "m05_query_times",
    with_views(
        "query_log",
        f"""SELECT user_id, CAST(started_at AS DATE) AS day, COUNT(*) AS queries, {exact_ratio(cents('SUM(seconds)'), 'COUNT(seconds)')} AS avg_seconds,
        quantile_disc(seconds, 0.95) AS p95_seconds FROM query_log GROUP BY 1, 2""",
    ),
)
def m05(spark, sf_dir):
    return M.query_times(V.query_log(spark, sf_dir))


@query(
    "m06_change_counts",
    with_views(
        "changes",
        """SELECT time_bucket(INTERVAL 15 MINUTES, seq) AS interval_start, time_bucket(INTERVAL 15 MINUTES, seq) + INTERVAL 15 MINUTES AS interval_end,
        op, COUNT(*) AS change_count FROM changes GROUP BY 1, 2, 3""",
    ),
)
def m06(spark, sf_dir):
    return change_counts(V.changes(spark, sf_dir))


@query(
    "m07_capacity_use",
    with_views(
        "metering",
        """SELECT warehouse_name, strftime(start_time, '%Y-%m') AS month, COUNT(DISTINCT date_trunc('hour', start_time)) AS active_hours,
        CAST(SUM(credits_used) AS DECIMAL(28,2)) AS credits, COUNT(DISTINCT date_trunc('hour', start_time)) > 200 AS over_target
        FROM metering GROUP BY 1, 2""",
    ),
)
def m07(spark, sf_dir):
    return M.capacity_use(V.metering(spark, sf_dir))
