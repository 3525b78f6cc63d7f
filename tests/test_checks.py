import datetime as dt
from decimal import ROUND_HALF_UP
from decimal import Decimal as D

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trueledger.functions import ratio, safe_percent, status_below, status_exact, variance_band
from trueledger.operators import business, integrity, schema_checks, statistical, structural
from trueledger.plans import monitoring, suite
from trueledger.sources import generate


def values(spark, ddl, *data):
    return spark.createDataFrame(list(data), ddl)


@pytest.mark.parametrize(
    "pct, band",
    [
        ("-20.01", "Over Budget >20%"),
        ("-20", "Over Budget 10-20%"),
        ("-10", "On Target"),
        ("9.99", "On Target"),
        ("10", "Under Budget 10-20%"),
        ("20", "Under Budget >20%"),
        (None, "Under Budget >20%"),
    ],
)
def test_band_edges(spark, pct, band):
    df = values(spark, "p decimal(18,2)", (None if pct is None else D(pct),))
    assert df.select(variance_band(F.col("p"))).first()[0] == band


def test_status_edges(spark):
    df = values(spark, "v int", (0,), (99,), (100,), (9999,), (10000,), (None,))
    got = [r[0] for r in df.select(status_below(F.col("v"), 100, 10_000)).collect()]
    assert got == ["PASS", "PASS", "PASS_MINOR", "PASS_MINOR", "REVIEW", "REVIEW"]
    df = values(spark, "v int", (1000,), (1999,), (2000,), (1,), (0,))
    got = [r[0] for r in df.select(status_exact(F.col("v"), F.lit(1000), F.lit(1000))).collect()]
    assert got == ["PASS", "PASS_MINOR", "REVIEW", "PASS_MINOR", "REVIEW"]


def test_ratio_and_percent_never_divide_by_zero(spark):
    df = values(spark, "a decimal(18,2), b decimal(18,2)", (D("1.00"), D("0.00")), (D("1.00"), D("-5.00")), (D("1.00"), D("8.00")), (None, D("8.00")))
    assert [r[0] for r in df.select(safe_percent(F.col("a"), F.col("b"))).collect()] == [D("0.00"), D("0.00"), D("12.50"), None]
    assert df.select(ratio(F.col("a"), F.lit(0))).first()[0] is None


MONEY = st.decimals(min_value=-10_000_000, max_value=10_000_000, places=2)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(MONEY, st.integers(1, 10_000), MONEY), min_size=50, max_size=200))
def test_ratio_and_percent_round_half_up(spark, data):
    df = values(spark, "a decimal(18,2), n bigint, b decimal(18,2)", *data)
    got = df.select("a", "n", "b", ratio(F.col("a"), F.col("n")).alias("r"), safe_percent(F.col("a"), F.col("b")).alias("p")).collect()
    cent = D("0.01")
    for row in got:
        assert row.r == (row.a / row.n).quantize(cent, ROUND_HALF_UP)
        want = (row.a * 100 / row.b).quantize(cent, ROUND_HALF_UP) if row.b > 0 else D("0.00")
        assert row.p == want


def test_row_counts(spark):
    frames = {"vendors": spark.range(15), "cost_centers": spark.range(3), "invoices": spark.range(0)}
    expected = structural.expected_counts(spark, {"vendors": 10, "cost_centers": 3, "invoices": 0, "lost": 5})
    got = {r.table_name: (r.row_count, r.status) for r in structural.row_count_parity(frames, expected).collect()}
    assert got == {"vendors": (15, "PASS_MINOR"), "cost_centers": (3, "PASS"), "invoices": (0, "PASS"), "lost": (None, "REVIEW")}
    strict = {r.table_name: r.status for r in structural.strict_row_count(frames, expected).collect()}
    assert strict["vendors"] == "FAIL" and strict["cost_centers"] == "PASS"
    total = structural.dataset_total(frames, expected, 18).first()
    assert (total.total_rows, total.expected_rows, total.status) == (18, 18, "PASS")
    alerts = structural.count_variance_alerts(frames, expected, 0.01).collect()
    assert {(r.table_name, r.variance) for r in alerts} == {("vendors", D("0.500000")), ("lost", D("1.000000"))}


def test_references_count_null_keys_and_weigh_hot_keys(spark):
    child = values(spark, "k int", *[(1,)] * 500, (2,), (None,), (None,), (9,), (9,))
    parent = values(spark, "id int", (1,), (2,), (3,))
    check = integrity.foreign_key_check("c.k", child, ["k"], parent, ["id"]).first()
    assert (check.orphan_rows, check.orphan_keys, check.status) == (4, 2, "PASS_MINOR")
    assert integrity.orphan_rows(child, ["k"], parent, ["id"]).count() == 4
    whole = integrity.foreign_key_check("c.k", child.where("k = 1"), ["k"], parent, ["id"]).first()
    assert (whole.orphan_rows, whole.status) == (0, "PASS")
    empty = integrity.foreign_key_check("c.k", child.limit(0), ["k"], parent, ["id"]).first()
    assert (empty.orphan_rows, empty.status) == (0, "PASS")


def test_composite_reference(spark):
    child = values(spark, "a int, b int", (1, 1), (1, 2), (None, 1))
    parent = values(spark, "a int, b int", (1, 1))
    assert integrity.foreign_key_check("ab", child, ["a", "b"], parent).first().orphan_rows == 2


def test_coverage_ignores_nulls(spark):
    child = values(spark, "k string", ("a",), ("a",), ("b",), (None,))
    parent = values(spark, "k string", ("a",), ("a",), ("z",))
    got = integrity.key_coverage("k", child, "k", parent).first()
    assert (got.used_keys, got.valid_keys, got.missing_keys, got.status) == (2, 1, 1, "PASS_MINOR")


def test_duplicates(spark):
    df = values(spark, "k int", (1,), (1,), (1,), (2,), (None,), (None,))
    got = integrity.duplicate_summary("t", df, ["k"]).first()
    assert (got.duplicate_keys, got.surplus_rows, got.status) == (2, 3, "REVIEW")
    assert integrity.duplicate_summary("t", df.where("k = 2"), ["k"]).first().status == "PASS"


def test_nulls(spark):
    gl = values(
        spark,
        "transaction_id int, account_number string, debit_amount decimal(18,2), credit_amount decimal(18,2)",
        (1, "a", D(0), D(0)),
        (None, "a", D(1), D(0)),
        (3, None, None, D(0)),
    )
    got = integrity.critical_nulls(gl).first()
    assert (got.total_rows, got.null_ids, got.null_accounts, got.zero_amount_rows, got.status) == (3, 1, 1, 1, "REVIEW")
    assert rows(integrity.null_counts(gl, "gl", ["debit_amount", "transaction_id"])) == [("gl", "debit_amount", 3, 1), ("gl", "transaction_id", 3, 1)]


def test_balance_thresholds(spark):
    def status(debit, credit):
        df = values(spark, "debit_amount decimal(18,2), credit_amount decimal(18,2)", (D(debit), D(0)), (D(0), D(credit)))
        return business.gl_balance(df).first().status

    assert [status("199.99", "100"), status("200", "100"), status("100", "10099.99"), status("100", "10100")] == ["PASS", "PASS_MINOR", "PASS_MINOR", "REVIEW"]
    report = business.balance_report(business.gl_balance(values(spark, "debit_amount decimal(18,2), credit_amount decimal(18,2)", (D("1234567.5"), D(0)))))
    assert report.first().total_debits == "1,234,567.50"


def test_variance_rows(spark):
    ddl = "budget_id int, budget_amount decimal(18,2), actual_amount decimal(18,2), variance_amount decimal(18,2), variance_percent decimal(18,2)"
    df = values(spark, ddl, (1, D(100), D(110), D(10), D(10)), (2, D(100), D(110), D("10.01"), D(10)), (3, D(0), D(5), D(5), D(0)), (4, D(1), D(1), None, None))
    got = {r.budget_id: (r.calculated_percent, r.status) for r in business.variance_check(df).collect()}
    assert got == {1: (D("10.00"), "PASS"), 2: (D("10.00"), "FAIL"), 3: (D("0.00"), "PASS"), 4: (D("0.00"), "FAIL")}


def test_status_rules(spark):
    df = values(
        spark,
        "status string, invoice_amount decimal(18,2), paid_amount decimal(18,2), outstanding_amount decimal(18,2)",
        ("Paid", D(10), D(10), D(0)),
        ("Paid", D(10), D(5), D(5)),
        ("Open", D(10), D(0), D(10)),
        ("Open", D(10), D(1), D(9)),
        ("Overdue", D(10), D(1), D(9)),
    )
    got = {r.status: (r.invoice_count, r.invalid_paid, r.invalid_open) for r in business.status_rules(df).collect()}
    assert got == {"Paid": (2, 1, 0), "Open": (2, 0, 1), "Overdue": (1, 0, 0)}


def test_shares_sum_to_hundred(spark):
    df = values(spark, "status string, invoice_amount decimal(18,2), outstanding_amount decimal(18,2)", *[("A", D(1), D(1))] * 3, ("B", D(2), D(0)))
    got = {r.status: r.percentage for r in business.status_distribution(df).collect()}
    assert got == {"A": D("75.00"), "B": D("25.00")}


def test_date_coverage(spark):
    df = values(spark, "transaction_date date, fiscal_year int", (dt.date(2022, 1, 1), 2022), (dt.date(2024, 12, 31), 2024))
    assert business.date_coverage(df, 2022, 2025).first().status == "PASS"
    assert business.date_coverage(df, 2023, 2025).first().status == "REVIEW"
    assert business.date_coverage(df, 2022, 2025, 2000).first().status == "REVIEW"


def test_schema_drift(spark):
    source = {"t": values(spark, "a int, b string, c decimal(10,2)", (1, "x", D(1)))}
    target = {"t": source["t"].select("a", F.col("c").cast("decimal(10,1)").alias("c"), F.lit(1).alias("d"))}
    got = {r.column_name: r.drift for r in schema_checks.schema_drift(spark, source, target, compare_nullability=False).collect()}
    assert got == {"b": "MISSING", "c": "TYPE", "d": "ADDED"}
    assert schema_checks.schema_drift(spark, source, source).count() == 0
    assert schema_checks.schema_drift(spark, source, {}).count() == 3


def test_distribution_gap_sees_vanished_category(spark):
    s = values(spark, "c string", ("a",), ("a",), ("b",), (None,))
    t = values(spark, "c string", ("a",), ("a",), ("a",), (None,))
    got = {r.c: (r.source_count, r.target_count, r.gap) for r in statistical.distribution_gap(s, t, "c").collect()}
    assert got == {"a": (2, 3, D("25.0000")), "b": (1, 0, D("25.0000")), None: (1, 1, D("0.0000"))}


def test_outliers(spark):
    df = values(spark, "v decimal(18,2)", *[(D(10),)] * 50, *[(D(11),)] * 50, (D(500),), (None,))
    assert [r.v for r in statistical.outliers(df, "v").collect()] == [D(500)]
    assert statistical.outliers(df.limit(1), "v").count() == 0


@pytest.mark.parametrize("p, want", [("0.50", 5), ("0.95", 10), ("0.90", 9), ("0.91", 10)])
def test_discrete_percentile(spark, p, want):
    df = spark.range(1, 11).withColumn("k", F.lit("a"))
    assert statistical.discrete_percentile(df, ["k"], "id", p, "v").first().v == want


def test_date_ranges_and_precision(spark):
    s = values(spark, "d date, m decimal(18,2)", (dt.date(2024, 1, 1), D("1.25")), (None, None))
    t = s.select("d", F.col("m").cast("decimal(18,1)").alias("m"))
    assert statistical.date_ranges(s, t, "t").first().status == "PASS"
    assert statistical.date_ranges(s, t.limit(0), "t").first().status == "REVIEW"
    got = statistical.numeric_precision(s, t).first()
    assert (got.source_scale, got.target_scale, got.status) == (2, 1, "REVIEW")
    assert statistical.numeric_precision(s, s).first().status == "PASS"


SMALL = {"chart_of_accounts": 20, "cost_centers": 10, "vendors": 30, "budget_actual": 200, "invoices": 1000, "gl_transactions": 2000}


def test_suite_passes_on_a_faithful_copy(spark):
    fin = generate.generate(spark, SMALL)
    results = suite.run_suite(spark, fin, fin)
    assert [r for r in results.where("status <> 'PASS'").collect()] == []
    assert {r.category: r.pass_rate for r in suite.summary(results).collect()} == {c: D("100.00") for c in suite.CATEGORIES}


def test_suite_reports_what_was_broken(spark):
    fin = generate.generate(spark, SMALL)
    broken = dict(fin)
    broken["vendors"] = fin["vendors"].where("vendor_id <> 7")
    broken["gl_transactions"] = fin["gl_transactions"].withColumn("account_name", F.when(F.col("transaction_id") != 5, F.col("account_name")))
    failed = {(r.check_id, r.entity, r.metric) for r in suite.run_suite(spark, fin, broken).where("status <> 'PASS'").collect()}
    assert ("V-14", "gl_transactions", "nulls:account_name") in failed
    assert ("V-11", "invoices.vendor_id->vendors", "orphan_rows") in failed
    assert ("V-01", "vendors", "row_count") in failed
    drilled = suite.violations(broken)["V-11 invoices.vendor_id->vendors"]
    assert drilled.count() == fin["invoices"].where("vendor_id = 7").count() > 0


def test_logged_suite_feeds_the_monitoring(spark, folder):
    """A copy that is broken, then mended: the log has seconds per check, and the alert is raised and cleared."""
    fin = generate.generate(spark, SMALL)
    broken = {**fin, "vendors": fin["vendors"].where("vendor_id <= 15")}
    days = [dt.datetime(2024, 5, d, 12) for d in (1, 2, 3)]
    runs = [suite.run_logged(spark, fin, copy, folder, f"r{i}", day) for i, (copy, day) in enumerate(zip([fin, broken, fin], days, strict=True))]
    whole = suite.run_suite(spark, fin, broken)
    assert rows(runs[1].select(*suite.RESULT)) == rows(whole)
    log = spark.read.parquet(folder)
    assert log.count() == 3 * whole.count() and log.where("seconds IS NULL OR seconds <= 0").count() == 0
    states = monitoring.alert_states(spark, monitoring.check_outcomes(log))
    failed = {r.check_id for r in whole.where("status = 'REVIEW'").collect()}
    assert "V-11" in failed and failed == {r.entity for r in states.collect()}
    assert {(r.raised_at, r.cleared_at, r.failures) for r in states.collect()} == {(days[1], days[2], 1)}
    assert monitoring.open_alerts(states).count() == 0
    only = log.where("run_id <> 'r2'")
    assert {r.entity for r in monitoring.open_alerts(monitoring.alert_states(spark, monitoring.check_outcomes(only))).collect()} == failed
    trend = monitoring.pass_rate_trend(log.where("check_id = 'V-11'")).orderBy("run_date").collect()
    assert [(r.runs, r.failures) for r in trend] == [(4, 0), (4, 1), (4, 0)]


def test_a_check_that_cannot_run_is_logged(spark, folder):
    fin = generate.generate(spark, SMALL)
    fails = fin["vendors"].withColumn("payment_terms", F.raise_error(F.lit("gone")).cast("string"))
    found = suite.run_logged(spark, fin, {**fin, "vendors": fails}, folder, "r", dt.datetime(2024, 5, 1))
    crashed = {r.check_id for r in found.where("metric = 'ran'").collect()}
    assert "V-22" in crashed and "V-01" not in crashed
    assert found.where("metric = 'ran' AND status = 'REVIEW' AND detail LIKE '%gone%'").count() == len(crashed)


def test_alert_states(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    data = [("t", d, str(d), f) for d, f in enumerate([False, True, True, False, False, True, False, True], 1)]
    data += [("u", 1, "a", False), ("u", 2, "b", False), ("v", 3, "a", True), ("v", 3, "b", False), ("v", 4, "a", True)]
    log = values(spark, "entity string, d int, run_id string, failed boolean", *data)
    outcomes = log.select(F.lit("sync_failed").alias("metric"), "entity", F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(d - 1)").alias("at"), "run_id", "failed")
    states = monitoring.alert_states(spark, outcomes.repartition(3))
    assert rows(states.drop("severity", "metric")) == sorted(
        [
            ("t", day(2), day(3), 2, day(4)),
            ("t", day(6), day(6), 1, day(7)),
            ("t", day(8), day(8), 1, None),
            ("v", day(3), day(3), 1, day(3)),
            ("v", day(4), day(4), 1, None),
        ],
        key=repr,
    )
    assert {r.severity for r in states.collect()} == {"Critical"}
    assert monitoring.open_alerts(states).count() == 2


def test_metrics_of_a_window(spark):
    log = values(spark, "table_name string, run_id long, sync_start timestamp_ntz, error string", ("a", 1, dt.datetime(2024, 1, 1), "x"), ("a", 2, dt.datetime(2024, 2, 1), None))
    checks = values(spark, "category string, status string, run_ts timestamp_ntz", ("c", "REVIEW", dt.datetime(2024, 1, 1)), ("c", "PASS", dt.datetime(2024, 2, 1)))
    metering = values(spark, "warehouse_name string, start_time timestamp_ntz, credits_used decimal(18,2)", ("w", dt.datetime(2024, 2, 1), D("1")))
    found = lambda since: {r.metric for r in monitoring.alerts(spark, monitoring.metrics(log, checks, metering, "100", since=since)).collect()}
    assert found(None) == {"sync_failed", "check_failed"} and found(dt.datetime(2024, 1, 2)) == set()


@pytest.mark.parametrize("kind", ["bigint", "decimal(18,2)", "decimal(38,4)", "double"])
def test_percentile_of_a_heavy_tail(spark, kind):
    """One value a million times the rest, many ties, a hot group: the values put in order stay few, the result exact."""
    n = 60_000
    base = spark.range(n).select(F.when(F.col("id") % 10 == 0, "small").otherwise("hot").alias("k"), F.pmod(F.xxhash64("id"), F.lit(10**6)).alias("x"))
    df = base.select("k", F.when(F.col("x") % 7 == 0, 5).when(F.col("x") == F.lit(1), F.lit(10**12)).otherwise(F.col("x")).cast(kind).alias("v"))
    df = df.unionByName(spark.createDataFrame([("hot", 10**15), ("hot", None), ("one", 3)], "k string, v bigint").withColumn("v", F.col("v").cast(kind)))
    for p in ("0.05", "0.50", "0.95", "0.99", "1.00"):
        found = dict(rows(statistical.discrete_percentile(df, ["k"], "v", p, "q")))
        for k in ("small", "hot", "one"):
            every = sorted(r.v for r in df.where((F.col("k") == k) & F.col("v").isNotNull()).collect())
            assert found[k] == every[-(-len(every) * int(float(p) * 100) // 100) - 1], (k, p)
        bracket = statistical.percentile_bracket(df, ["k"], "v", p)
        inside = df.join(bracket, "k").where("CAST(v AS DOUBLE) >= _lo AND CAST(v AS DOUBLE) <= _hi").groupBy("k").agg(F.count_distinct("v").alias("n"))
        assert all(r.n <= 2 * 4 * n / statistical.SKETCH_ACCURACY + 2 for r in inside.collect())
