import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trueledger.operators import business, diff, integrity
from trueledger.plans import jobs
from trueledger.schemas import FOREIGN_KEYS, INVOICES, PRIMARY_KEYS, TABLES
from trueledger.session import work_dir
from trueledger.sources import exports, generate, snapshots, tables

SMALL = {"chart_of_accounts": 20, "cost_centers": 10, "vendors": 30, "budget_actual": 200, "invoices": 3000, "gl_transactions": 2000}


@pytest.fixture(scope="module")
def fin(spark):
    return generate.generate(spark, SMALL)


@pytest.mark.parametrize("name", list(TABLES))
def test_generated_tables_have_their_schema_and_keys(fin, name):
    df = fin[name]
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in TABLES[name].fields]
    assert df.count() == SMALL[name]
    assert integrity.duplicate_keys(df, PRIMARY_KEYS[name]).count() == 0


def test_generated_references_and_rules_hold(fin):
    for fk in FOREIGN_KEYS:
        assert integrity.orphan_rows(fin[fk.child], [fk.column], fin[fk.parent]).count() == 0
    assert business.gl_balance(fin["gl_transactions"]).first().difference == 0
    assert business.variance_check(fin["budget_actual"]).where("status = 'FAIL'").count() == 0
    shares = {r.status: float(r.percentage) for r in business.status_distribution(fin["invoices"]).collect()}
    for status, share in {"Paid": 60, "Open": 20, "Overdue": 15, "Cancelled": 5}.items():
        assert abs(shares[status] - share) < 3
    rule = business.status_rules(fin["invoices"]).agg(F.sum("invalid_paid"), F.sum("invalid_open")).first()
    assert tuple(rule) == (0, 0)


def test_same_seed_same_rows_for_any_partitioning(spark, monkeypatch):
    first = {n: diff.fingerprint(df, n).first() for n, df in generate.generate(spark, SMALL).items()}
    monkeypatch.setattr(generate, "ROWS_PER_PARTITION", 137)
    split = generate.generate(spark, SMALL)
    assert split["invoices"].rdd.getNumPartitions() > 10
    assert {n: diff.fingerprint(df, n).first() for n, df in split.items()} == first
    other = generate.generate(spark, SMALL, seed=43)
    assert diff.fingerprint(other["invoices"], "invoices").first() != first["invoices"]


def test_full_size_is_scaled(spark):
    made = generate.generate(spark, scale=0.0001)
    assert made["gl_transactions"].count() == 3000 and made["vendors"].count() == 1


def test_load_verify_and_summary(spark, fin, folder):
    report = snapshots.load(spark, fin, folder)
    assert [r.table_name for r in report.collect()] == list(TABLES)
    expected = spark.createDataFrame([*SMALL.items()], "table_name string, row_count bigint")
    assert snapshots.verify_load(spark, folder, expected).where("valid").count() == 6
    wrong = spark.createDataFrame([("vendors", 31)], "table_name string, row_count bigint")
    assert not snapshots.verify_load(spark, folder, wrong).first().valid
    assert snapshots.load_summary(spark, folder, list(TABLES)).first().total_rows == sum(SMALL.values())
    snapshots.load(spark, {"vendors": fin["vendors"].limit(3)}, folder)
    assert tables.read_table(spark, folder, "vendors").count() == 3


def test_generate_and_load_job(spark, folder):
    done = jobs.generate_and_load(spark, folder, SMALL)
    assert done.report.where("loaded").count() == done.verification.where("valid").count() == 6
    assert done.summary.first().total_rows == sum(SMALL.values())


def test_missing_table_is_not_valid(spark, folder):
    expected = spark.createDataFrame([("vendors", 3)], "table_name string, row_count bigint")
    assert rows(snapshots.verify_load(spark, folder, expected)) == [("vendors", None, 3, False)]


def test_one_failing_table_does_not_stop_the_others(spark, fin, folder):
    broken = fin["vendors"].withColumn("vendor_name", F.raise_error(F.lit("source unreadable")).cast("string"))
    report = snapshots.load(spark, {"vendors": broken, "cost_centers": fin["cost_centers"]}, folder)
    got = {r.table_name: r.loaded for r in report.collect()}
    assert got == {"vendors": False, "cost_centers": True}
    assert report.where("NOT loaded").first().error


def test_overview_counts_bytes_on_disk(spark, fin, folder):
    snapshots.load(spark, {"vendors": fin["vendors"], "cost_centers": fin["cost_centers"]}, folder)
    paths = {n: f"{folder}/{n}" for n in ("vendors", "cost_centers")}
    on_disk = {n: sum(e.stat().st_size for e in os.scandir(p) if e.name.endswith(".parquet")) for n, p in paths.items()}
    stored = {r.table_name: (r.row_count, r.bytes) for r in tables.storage_metadata(spark, paths).collect()}
    assert stored == {n: (SMALL[n], on_disk[n]) for n in paths}
    assert [r.table_name for r in tables.table_overview(spark, paths).collect()] == ["vendors", "cost_centers"]


def test_namespace_and_catalog_load(spark, fin, folder):
    tables.ensure_namespace(spark, "finance_test", f"{folder}/db")
    tables.ensure_namespace(spark, "finance_test", f"{folder}/db")
    snapshots.load_into({"vendors": fin["vendors"]}, "finance_test", folder)
    assert spark.table("finance_test.vendors").count() == 30
    with pytest.raises(ValueError):
        tables.ensure_namespace(spark, "x; DROP TABLE y")
    spark.sql("DROP TABLE finance_test.vendors")


def test_versions_appear_only_when_published(spark, fin, folder):
    assert snapshots.latest_version(spark, folder, "vendors") == 0
    snapshots.snapshot(spark, {"vendors": fin["vendors"]}, folder)
    fin["vendors"].limit(1).write.parquet(snapshots.version_path(folder, "vendors", 2))
    assert snapshots.read_version(spark, folder, "vendors").count() == 30
    snapshots.snapshot(spark, {"vendors": fin["vendors"].limit(7)}, folder)
    assert snapshots.read_version(spark, folder, "vendors").count() == 7
    assert snapshots.read_version(spark, folder, "vendors", 1).count() == 30


def test_a_failing_copy_does_not_hold_back_the_others(spark, fin, folder):
    broken = fin["vendors"].withColumn("vendor_name", F.raise_error(F.lit("source unreadable")).cast("string"))
    with pytest.raises(Exception, match="source unreadable"):
        snapshots.snapshot(spark, {"vendors": broken, "cost_centers": fin["cost_centers"]}, folder)
    assert snapshots.latest_version(spark, folder, "vendors") == 0
    assert snapshots.read_version(spark, folder, "cost_centers").count() == 10


def test_labelled_versions(spark, fin, folder):
    snapshots.snapshot(spark, {"vendors": fin["vendors"]}, folder, "before cut-over")
    snapshots.snapshot(spark, {"vendors": fin["vendors"].limit(5)}, folder)
    version = snapshots.labelled_version(spark, folder, "vendors", "before cut-over")
    assert snapshots.read_version(spark, folder, "vendors", version).count() == 30
    assert snapshots.labelled_version(spark, folder, "vendors", "unknown") == 0


@pytest.mark.parametrize(
    "day, want",
    [("2001-03-01", "hot"), ("2000-01-01", "hot"), ("1999-12-31", "warm"), ("1999-03-01", "warm"), ("1999-02-28", "archive")],
)
def test_tier_edges(spark, day, want):
    df = spark.createDataFrame([(dt.date.fromisoformat(day),)], "d date")
    assert df.select(exports.tier("d", dt.date(2001, 3, 1))).first()[0] == want


def test_archive_and_tiers_keep_every_row(spark, fin, folder):
    gl = fin["gl_transactions"]
    exports.archive(gl, f"{folder}/a", "transaction_date", dt.date(2023, 1, 1))
    assert spark.read.parquet(f"{folder}/a").count() == gl.where("transaction_date < '2023-01-01'").count() > 0
    assert os.path.isdir(f"{folder}/a/fiscal_year=2022")
    exports.write_tiers(gl, f"{folder}/t", "transaction_date", dt.date(2024, 12, 31))
    assert spark.read.parquet(f"{folder}/t").count() == gl.count()


def test_csv_round_trip_keeps_quotes_and_nulls(spark, fin, folder):
    odd = fin["invoices"].withColumn("invoice_number", F.concat(F.lit('a "b", c\\'), F.col("invoice_number")))
    exports.export_csv(odd, folder)
    assert diff.same_content(odd, exports.read_csv(spark, folder, INVOICES), "invoices").first().same


def test_log_retention(spark, folder):
    log = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i)) for i in range(120)], "id int, t timestamp_ntz")
    exports.append_log(log.where("id < 60"), folder, "t")
    exports.append_log(log.where("id >= 60"), folder, "t")
    kept = exports.retained(spark.read.parquet(folder), dt.date(2024, 4, 29))
    assert kept.count() == 91 and rows(kept.select(F.min("id"))) == [(29,)]


def test_csv_keeps_blanks_empty_text_breaks_and_microseconds(spark, folder):
    data = [(1, "  lead trail  ", dt.datetime(2024, 1, 2, 3, 4, 5, 123456)), (2, "", None), (3, 'line\nbreak, "quoted"\r\nagain', None), (4, None, dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(data, "id int, text string, at timestamp_ntz")
    exports.export_csv(df, folder)
    back = exports.read_csv(spark, folder, df.schema)
    assert rows(back) == sorted(data, key=repr)
    assert diff.same_content(df, back, "odd").first().same
    with pytest.raises(Exception):
        exports.read_csv(spark, folder, "id int, text string, at int").collect()


def test_a_failing_write_is_reported_whole(spark, fin, folder):
    open(f"{folder}/file", "w").close()  # a file where a folder is needed
    report = snapshots.load(spark, {"vendors": fin["vendors"], "invoices": fin["invoices"]}, f"{folder}/file").collect()
    assert [r.loaded for r in report] == [False, False] and all("file" in r.error for r in report)
    with pytest.raises(Exception):
        snapshots.snapshot(spark, {"vendors": fin["vendors"]}, f"{folder}/file")


def test_an_empty_table_counts(spark, fin, folder):
    frames = {"vendors": fin["vendors"].limit(0), "cost_centers": fin["cost_centers"]}
    snapshots.load(spark, frames, folder)
    got = snapshots.load_summary(spark, folder, list(frames)).first()
    assert (got.tables, got.total_rows) == (2, fin["cost_centers"].count())


def test_work_folder_must_be_shared_off_this_machine():
    class Elsewhere:
        conf = {"spark.master": "yarn"}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(Elsewhere, "x")


def test_rows_are_counted_as_they_are_written(spark, fin, folder, monkeypatch):
    """The copy is not read again: the manifest's counts come from the write itself."""
    counted = []
    monkeypatch.setattr(type(fin["vendors"]), "count", lambda df: counted.append(df) or -1)
    published = snapshots.snapshot(spark, {**fin, "empty": fin["vendors"].where("vendor_id < 0")}, folder)
    monkeypatch.undo()
    assert not counted
    assert dict(rows(published.select("table_name", "row_count"))) == {**SMALL, "empty": 0}
    group = "snapshot-jobs"
    spark.sparkContext.setJobGroup(group, "one copy")
    snapshots.snapshot(spark, {"vendors": fin["vendors"]}, f"{folder}-2")
    with_manifest = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    assert with_manifest <= 4  # is there a version already, the copy, its manifest row


def test_every_failing_copy_is_named(spark, fin, folder):
    broken = {n: fin[n].withColumn("gone", F.raise_error(F.lit(f"{n} unreadable")).cast("string")) for n in ("vendors", "cost_centers")}
    with pytest.raises(Exception) as found:
        snapshots.snapshot(spark, broken, folder)
    told = str(found.value) + "".join(found.value.__notes__)
    assert "vendors unreadable" in told and "cost_centers unreadable" in told


def test_old_days_of_a_log_are_removed(spark, folder):
    log = spark.range(100).select("id", F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(int(id))").alias("t"))
    log = log.unionByName(log.limit(1).withColumn("t", F.lit(None).cast("timestamp_ntz")))
    exports.append_log(log, folder, "t")
    removed = exports.expire_log(spark, folder, dt.date(2024, 4, 9), 90)
    assert removed == [dt.date(2024, 1, 1) + dt.timedelta(days=d) for d in range(9)]
    assert spark.read.parquet(folder).count() == 92 and spark.read.parquet(folder).where("run_date < '2024-01-10'").count() == 0
    assert exports.expire_log(spark, folder, dt.date(2024, 4, 9), 90) == []


@pytest.mark.parametrize("times", ["3", "0.37"])
def test_generated_shares_are_the_given_shares(spark, times):
    skewed = spark.range(2_000).select(
        F.when(F.col("id") < 700, 1).when(F.col("id") < 705, None).otherwise(F.col("id") % 400).cast("bigint").alias("vendor_id"),
        F.concat(F.lit("CC"), (F.col("id") % 7).cast("string")).alias("cost_center"),
        (F.col("id") % 31).cast("string").alias("account_number"),
        F.element_at(F.array(*map(F.lit, ["Paid", "Open", "Overdue", "Cancelled"])), (F.col("id") % 4 + 1).cast("int")).alias("status"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("invoice_date"),
    )
    n = int(2_000 * float(times))
    made = generate.invoices_like(spark, skewed, n)
    assert made.count() == n and made.select("invoice_id").distinct().count() == n
    assert [(f.name, f.dataType) for f in made.schema.fields] == [(f.name, f.dataType) for f in TABLES["invoices"].fields]
    for c in ("vendor_id", "cost_center", "account_number", "status", "invoice_date"):
        want = {r[0]: r[1] * n / 2_000 for r in skewed.groupBy(c).count().collect()}
        found = {r[0]: r[1] for r in made.groupBy(c).count().collect()}
        assert all(abs(found.get(v, 0) - share) < 1 for v, share in want.items()) and set(found) <= set(want), c
    # Columns are drawn independently of each other.
    assert made.select("status", "cost_center").distinct().count() == 28 or n < 500


def test_ranges_of_values_cover_all_places_once(spark):
    df = spark.range(500).select((F.col("id") % 13).alias("v"))
    found = sorted((r.lo, r.hi) for r in generate.weighted_ranges(df, "v").collect())
    assert found[0][0] == 0 and found[-1][1] == 500 and all(a[1] == b[0] for a, b in zip(found, found[1:]))


def test_generation_needs_given_rows(spark, fin):
    with pytest.raises(ValueError, match="no given row"):
        generate.invoices_like(spark, fin["invoices"].limit(0), 10)


def test_a_text_that_would_come_back_as_null_is_refused(spark, folder):
    df = spark.createDataFrame([("a",), (exports._NULL,)], "v string")
    with pytest.raises(Exception, match="read as NULL"):
        exports.export_csv(df, folder)
