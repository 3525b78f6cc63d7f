"""What the physical plans must look like."""

import re

import pytest

from pyspark.sql import functions as F

from trueledger import registry
from trueledger.operators import cdc
from trueledger.plans import analytics, suite
from trueledger.sources import generate
from trueledger.sources import testviews as V

registry.load_all()


def plan(df):
    return df._jdf.queryExecution().toString()


FACT_QUERIES = ["q01_monthly_pnl", "q03_vendor_payments", "q06_ledger_by_year", "v08_orphan_invoices", "v17_duplicate_keys", "f05_cell_diff", "f06_fingerprint"]


@pytest.mark.parametrize("name", FACT_QUERIES)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(registry.QUERIES[name](spark, sf_dir))
    for node in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_reference_check_is_an_anti_join_after_the_sum(spark, sf_dir):
    text = plan(registry.QUERIES["v08_orphan_invoices"](spark, sf_dir)).split("== Physical Plan ==")[1]
    assert "LeftAnti" in text
    assert "partial_count" in text


def test_large_dimension_is_not_broadcast(spark, sf_dir):
    """Nothing forces a broadcast: with the size limit off, every lookup is sort-merged."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("q01_monthly_pnl", "q03_vendor_payments", "v08_orphan_invoices", "g04_fixed_mapping"):
            text = plan(registry.QUERIES[name](spark, sf_dir)).split("== Physical Plan ==")[1]
            assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_vendor_sum_and_join_share_one_shuffle(spark, sf_dir):
    """Summed by vendor id, the invoices are already where the join wants them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(registry.QUERIES["q10_vendor_terms"](spark, sf_dir)).split("== Physical Plan ==")[1]
        by_vendor = re.findall(r"Exchange hashpartitioning\(vendor_id#\d+L?, \d+\)", text)
        assert len(by_vendor) == 2  # one for invoices, one for vendors
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ledger_scan_reads_only_what_the_report_needs(spark, sf_dir):
    text = plan(registry.QUERIES["q01_monthly_pnl"](spark, sf_dir))
    schema = re.search(r"ReadSchema: struct<([^>]*l_partkey[^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_partkey", "l_extendedprice", "l_linestatus", "l_shipdate"}
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate,1999-01-01", text)


def test_lookup_is_skipped_when_not_asked_for(spark, sf_dir):
    assert "supplier" not in plan(V.gl_transactions(spark, sf_dir, V.LEDGER_ONLY))
    assert "supplier" in plan(V.gl_transactions(spark, sf_dir))


def test_top_k_keeps_k_rows_per_task(spark, sf_dir):
    for name in ("q02_top_cost_centers", "q05_vendor_spend", "o03_seeded_sample", "v06_balance_by_period"):
        assert "TakeOrderedAndProject" in plan(registry.QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["v20_status_distribution", "v21_variance_distribution", "v22_distribution_gap"])
def test_single_partition_windows_see_aggregated_rows_only(spark, sf_dir, name):
    text = plan(registry.QUERIES[name](spark, sf_dir)).split("== Physical Plan ==")[1]
    for below in text.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate" in below.split("Scan")[0]


def test_small_change_batch_leaves_the_state_where_it_is(spark, sf_dir):
    state = cdc.as_state(V.invoices(spark, sf_dir), 0)
    batch = generate.test_invoices(spark, F.lit(10**9), 100, F.current_date())
    changes = batch.select("*", F.lit("I").alias("op"), F.lit(1).alias("seq"), F.lit(0).cast("bigint").alias("tie"))
    merged = cdc.merge_latest(state, cdc.latest_changes(changes, ["invoice_id"]), ["invoice_id"])
    physical = merged._jdf.queryExecution().executedPlan().toString()
    updated = physical.split("Union")[1].split("LeftAnti")[0]
    assert "BroadcastHashJoin" in updated and "SortMergeJoin" not in updated
    state_rows = updated.split("BuildRight")[1].split("BroadcastExchange")[0]
    assert "FileScan" in state_rows and "Exchange" not in state_rows


def test_a_hot_account_is_split(spark, monkeypatch):
    """Three quarters of the ledger on one account, sort-merged: AQE splits its partition, and the sums stay whole."""
    monkeypatch.setattr(generate, "ROWS_PER_PARTITION", 20_000)
    fin = generate.generate(spark, {**generate.FULL_SIZE, "gl_transactions": 200_000, "invoices": 10, "budget_actual": 10})
    hot = F.when(F.col("transaction_id") % 4 != 0, "1000").otherwise(F.col("account_number"))
    gl = fin["gl_transactions"].withColumn("account_number", hot)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        report = analytics.monthly_pnl(gl, fin["chart_of_accounts"], 2022)
        total = report.collect()
        final = report._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key)
    assert "skew=true" in final
    assert sum(r.transaction_count for r in total) == 200_000


def test_the_suite_reads_the_copied_ledger_twice_besides_duplicates(spark, folder):
    """Once for all counts and sums, once for both references; keys are looked up in their own pass."""
    made = generate.generate(spark, {**generate.FULL_SIZE, "gl_transactions": 2_000, "invoices": 500, "budget_actual": 100})
    source, target = ({n: stored_as(spark, df, f"{folder}/{side}/{n}") for n, df in made.items()} for side in ("source", "target"))
    ledger_scans = lambda df: sum("Relation [transaction_id" in line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert ledger_scans(suite.reference_results(target)[0]) == 1
    # One of the source; of the copy one for all measures, one for its references and one for duplicates.
    assert ledger_scans(suite.run_suite(spark, source, target)) == 4


def stored_as(spark, df, path):
    df.write.parquet(path)
    return spark.read.parquet(path)
