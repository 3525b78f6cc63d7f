"""Copy fidelity and change apply by name."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from trueledger.operators import cdc, diff, evolve, schema_checks
from trueledger.registry import query
from trueledger.registry.checks import SQL_NAME, both, both_sql
from trueledger.registry.ctes import with_views
from trueledger.schemas import TABLES
from trueledger.session import work_dir
from trueledger.sources import generate, snapshots
from trueledger.sources import testviews as V
from trueledger.sources.change_table import ChangeTable
from trueledger.sources.tables import union_all
from trueledger.streaming import cdc_stream
from trueledger.streaming.change_counts import CountTable, count_stream

TODAY = dt.date(2001, 3, 1)
KEYS = ["account_id"]

LATEST = """SELECT account_id, arg_max(op, (seq, tie)) AS op, MAX(seq) AS seq, arg_max(balance, (seq, tie)) AS balance,
    arg_max(last_event, (seq, tie)) AS last_event FROM changes GROUP BY 1"""
LIVE = with_views("changes", f"SELECT account_id, balance, last_event FROM ({LATEST}) WHERE op <> 'D'")


def _with_test_batch(spark, sf_dir):
    """The invoices as a state, and 100 new test invoices as an insert batch."""
    inv = V.invoices(spark, sf_dir)
    last_id = inv.agg(F.max("invoice_id")).scalar()
    new = generate.test_invoices(spark, last_id, 100, F.lit(TODAY))
    return cdc.as_state(inv, 0), new.select("*", F.lit("I").alias("op"), F.lit(1).alias("seq"), F.lit(0).cast("bigint").alias("tie"))


@query(
    "f02_insert_batch",
    with_views(
        "inv",
        """SELECT COUNT(*) + 100 AS total_rows, CAST(100 AS BIGINT) AS test_rows, MAX(invoice_id) + 100 AS last_id,
        CAST(100 AS BIGINT) AS open_test_rows, 'INV-TEST-000001' AS first_number, 'INV-TEST-000100' AS last_number FROM inv""",
    ),
)
def f02(spark, sf_dir):
    state, inserts = _with_test_batch(spark, sf_dir)
    after = cdc.live_rows(cdc.apply_changes(state, inserts, ["invoice_id"]))
    test = F.col("invoice_number").like("INV-TEST-%")
    number = F.when(test, F.col("invoice_number"))
    return after.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(test).alias("test_rows"),
        F.max("invoice_id").alias("last_id"),
        F.count_if(test & (F.col("status") == "Open")).alias("open_test_rows"),
        F.min(number).alias("first_number"),
        F.max(number).alias("last_number"),
    )


@query(
    "f03_update_batch",
    with_views(
        "inv",
        """SELECT status, COUNT(*) AS invoice_count, CAST(COUNT(*) FILTER (is_test) AS BIGINT) AS test_rows FROM (
        SELECT status, FALSE AS is_test FROM inv UNION ALL SELECT CASE WHEN (m + i) % 2 = 0 THEN 'Paid' ELSE 'Open' END, TRUE
        FROM (SELECT MAX(invoice_id) AS m FROM inv), range(1, 101) AS r(i)) GROUP BY 1""",
    ),
)
def f03(spark, sf_dir):
    state, inserts = _with_test_batch(spark, sf_dir)
    updates = generate.mark_even_paid(inserts, F.lit(TODAY)).withColumns({"op": F.lit("U"), "seq": F.lit(2)})
    after = cdc.live_rows(cdc.apply_changes(state, inserts.unionByName(updates), ["invoice_id"]))
    return after.groupBy("status").agg(
        F.count(F.lit(1)).alias("invoice_count"), F.count_if(F.col("invoice_number").like("INV-TEST-%")).alias("test_rows")
    )


@query(
    "f04_deletes",
    with_views("changes", f"SELECT account_id, seq AS deleted_at FROM ({LATEST}) WHERE op = 'D'"),
)
def f04(spark, sf_dir):
    state = cdc.apply_changes(None, V.changes(spark, sf_dir), KEYS)
    return state.where("op = 'D'").select("account_id", F.col("seq").alias("deleted_at"))


PAIR = """, s AS (SELECT *, COUNT(*) OVER (PARTITION BY invoice_id) AS n FROM inv), t AS (SELECT *, COUNT(*) OVER (PARTITION BY invoice_id) AS n FROM t_inv),
    k AS (SELECT COALESCE(s.invoice_id, t.invoice_id) AS invoice_id, COALESCE(MAX(s.n), 0) AS source_rows, COALESCE(MAX(t.n), 0) AS target_rows
      FROM s FULL JOIN t USING (invoice_id) GROUP BY 1)"""
CHANGED = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in TABLES["invoices"].names)


@query(
    "f05_row_diff",
    with_views(
        "inv t_inv",
        PAIR
        + f"""SELECT invoice_id, source_rows, target_rows, CASE WHEN target_rows = 0 THEN 'MISSING' WHEN source_rows = 0 THEN 'EXTRA' ELSE 'DUPLICATE' END AS difference
        FROM k WHERE source_rows <> target_rows
        UNION ALL SELECT s.invoice_id, 1, 1, 'CHANGED' FROM s JOIN t ON s.invoice_id = t.invoice_id AND s.n = 1 AND t.n = 1 WHERE {CHANGED}""",
    ),
)
def f05(spark, sf_dir):
    inv = V.invoices(spark, sf_dir)
    return diff.key_differences(inv, V.faulty_invoices(inv), ["invoice_id"])


def _cells(condition) -> str:
    return " UNION ALL ".join(
        f"SELECT s.invoice_id, 'CHANGED' AS difference, '{c}' AS column_name, CAST(s.{c} AS VARCHAR) AS source_value, CAST(t.{c} AS VARCHAR) AS target_value "
        f"FROM s JOIN t ON s.invoice_id = t.invoice_id AND s.n = 1 AND t.n = 1 WHERE {condition(c)}"
        for c in TABLES["invoices"].names[1:]
    )


WHOLE = """SELECT invoice_id, CASE WHEN target_rows = 0 THEN 'MISSING' WHEN source_rows = 0 THEN 'EXTRA' ELSE 'DUPLICATE' END AS difference,
    CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS VARCHAR) AS source_value, CAST(NULL AS VARCHAR) AS target_value FROM k WHERE source_rows <> target_rows"""


@query("f05_cell_diff", with_views("inv t_inv", f"{PAIR} {_cells(lambda c: f's.{c} IS DISTINCT FROM t.{c}')} UNION ALL {WHOLE}"))
def f05_cells(spark, sf_dir):
    inv = V.invoices(spark, sf_dir)
    return diff.cell_differences(inv, V.faulty_invoices(inv), ["invoice_id"])


def _outside_tolerance(c: str) -> str:
    return f"abs(s.{c} - t.{c}) > 0.25" if c == "invoice_amount" else f"s.{c} IS DISTINCT FROM t.{c}"


@query(
    "v25_value_tolerance",
    with_views(
        "inv t_inv",
        f"{PAIR} SELECT difference, column_name, COUNT(*) AS cells FROM ({_cells(_outside_tolerance)} UNION ALL {WHOLE}) GROUP BY 1, 2",
    ),
)
def v25(spark, sf_dir):
    inv = V.invoices(spark, sf_dir)
    return diff.value_mismatches(inv, V.faulty_invoices(inv), ["invoice_id"], {"invoice_amount": "0.25"})


def _text(c: str, dtype) -> str:
    value = f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')" if dtype.simpleString() == "timestamp_ntz" else f"CAST({c} AS VARCHAR)"
    return f"COALESCE(length({value}) || ':' || {value}, '-')"


def _fingerprint_sql(table: str) -> str:
    texts = " || ".join(_text(f.name, f.dataType) for f in TABLES[table].fields)
    return (
        f"SELECT '{table}' AS table_name, COUNT(*) AS row_count, "
        f"CAST(SUM(CAST(CAST('0x' || substr(md5({texts}), 1, 15) AS UBIGINT) AS HUGEINT)) AS DECIMAL(38,0)) AS hash_sum FROM {{{SQL_NAME[table]}}}"
    )


@query("f06_fingerprint", both_sql(" ".join(SQL_NAME.values()), " UNION ALL ".join(_fingerprint_sql(t) for t in TABLES)))
def f06(spark, sf_dir):
    return both(lambda fin: union_all([diff.fingerprint(df, name) for name, df in fin.items()]))(spark, sf_dir)


@query(
    "f06_fast_parity",
    with_views(
        "inv t_inv vendors",
        "SELECT 'invoices' AS table_name, (SELECT COUNT(*) FROM inv) AS source_rows, (SELECT COUNT(*) FROM t_inv) AS target_rows, FALSE AS same "
        "UNION ALL SELECT 'vendors', (SELECT COUNT(*) FROM vendors), (SELECT COUNT(*) FROM vendors), TRUE",
    ),
)
def f06_fast(spark, sf_dir):
    """A faulty copy differs; a copy that is only partitioned otherwise does not."""
    inv, vendors = V.invoices(spark, sf_dir), V.vendors(spark, sf_dir)
    return union_all(
        [
            diff.same_content(inv, V.faulty_invoices(inv), "invoices"),
            diff.same_content(vendors, vendors.repartition("vendor_id"), "vendors"),
        ]
    )


@query("f07_apply_changes", LIVE)
def f07(spark, sf_dir):
    return cdc.live_rows(cdc.apply_changes(None, V.changes(spark, sf_dir), KEYS))


@query("f08_replayed_batches", LIVE)
def f08(spark, sf_dir):
    """Three batches by time applied to a stored state, the first one a second time at the end."""
    changes = V.changes(spark, sf_dir)
    table = ChangeTable(spark, work_dir(spark, "replay"), KEYS, buckets=16)
    first, second = (F.lit(d).cast("timestamp_ntz") for d in (dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21)))
    # The first batch has all that is older or has no time, the last one all that is later.
    early, late = F.coalesce(F.col("seq") < first, F.lit(True)), F.coalesce(F.col("seq") >= second, F.lit(False))
    batches = [changes.where(early), changes.where(~early & ~late), changes.where(late)]
    for batch in [*batches, batches[0]]:
        table.apply(batch)
    return table.live()


NOTE = "added with the new column"


def _evolved(spark, sf_dir):
    """Invoices followed by the invoices of a later batch that carry a new column."""
    inv = V.invoices(spark, sf_dir)
    cut = F.lit(dt.date(2001, 1, 1))
    later = F.coalesce(F.col("invoice_date") >= cut, F.lit(False))
    return evolve.evolve(inv.where(~later), inv.where(later).withColumn("notes", F.lit(NOTE)))


@query("e06_evolve", with_views("inv", f"SELECT *, CASE WHEN invoice_date >= DATE '2001-01-01' THEN '{NOTE}' END AS notes FROM inv"))
def e06(spark, sf_dir):
    return _evolved(spark, sf_dir)


@query(
    "e07_evolved_column",
    with_views(
        "inv",
        """SELECT 'invoices' AS table_name, 'notes' AS column_name, TRUE AS exists, COUNT(*) AS total_rows,
        COUNT(*) FILTER (invoice_date >= DATE '2001-01-01') AS populated_rows FROM inv
        UNION ALL SELECT 'invoices', 'project_code', FALSE, COUNT(*), 0 FROM inv""",
    ),
)
def e07(spark, sf_dir):
    df = _evolved(spark, sf_dir)
    return schema_checks.evolved_column(spark, df, "invoices", "notes").unionByName(
        schema_checks.evolved_column(spark, df, "invoices", "project_code")
    )


@query(
    "e08_resync",
    with_views("inv", "SELECT 2 AS version, COUNT(*) AS row_count, CAST(SUM(invoice_amount) AS DECIMAL(28,2)) AS total_amount FROM inv"),
)
def e08(spark, sf_dir):
    """A faulty copy replaced by a full re-sync."""
    root = work_dir(spark, "resync")
    inv = V.invoices(spark, sf_dir)
    snapshots.snapshot(spark, {"invoices": V.faulty_invoices(inv)}, root)
    snapshots.snapshot(spark, {"invoices": inv}, root)
    version = snapshots.latest_version(spark, root, "invoices")
    return (
        snapshots.read_version(spark, root, "invoices")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("invoice_amount").cast("decimal(28,2)").alias("total_amount"))
        .select(F.lit(version).alias("version"), "*")
    )


def _event_stream(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # Written as a pattern, the source may be one file as well as a folder of files.
    return V.change_columns(cdc_stream.change_stream(spark, f"{sf_dir}/{{events}}.parquet", schema))


@query("s11_change_source", with_views("changes", "SELECT op, COUNT(*) AS changes, MIN(seq) AS first_change, MAX(seq) AS last_change FROM changes GROUP BY 1"))
def s11(spark, sf_dir):
    root = work_dir(spark, "changes")
    running = (
        _event_stream(spark, sf_dir)
        .writeStream.format("parquet")
        .option("path", f"{root}/rows")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.parquet(f"{root}/rows").groupBy("op").agg(
        F.count(F.lit(1)).alias("changes"), F.min("seq").alias("first_change"), F.max("seq").alias("last_change")
    )


@query("m01_stream_apply", LIVE)
def m01(spark, sf_dir):
    root = work_dir(spark, "stream")
    table = ChangeTable(spark, f"{root}/state", KEYS, buckets=16)
    cdc_stream.apply_stream(_event_stream(spark, sf_dir), table, f"{root}/checkpoint").awaitTermination()
    return table.live()


@query(
    "m06_streamed_counts",
    with_views(
        "changes",
        """, newest AS (SELECT MAX(seq) - INTERVAL 2 DAY AS behind FROM changes WHERE seq >= TIMESTAMP '2024-01-16')
        SELECT time_bucket(INTERVAL 1 DAY, seq) AS interval_start, op, COUNT(*) AS change_count,
        COUNT(*) FILTER (seq < TIMESTAMP '2024-01-16' AND seq < behind) AS late_count FROM changes CROSS JOIN newest GROUP BY 1, 2""",
    ),
)
def m06_streamed(spark, sf_dir):
    """The files arrive in the wrong order: the newer half first, and the older one after a restart."""
    root = work_dir(spark, "counts")
    changes = V.changes(spark, sf_dir)
    older = F.coalesce(F.col("seq") < F.lit("2024-01-16").cast("timestamp_ntz"), F.lit(False))
    table = CountTable(spark, f"{root}/counts", "1 day", "2 days")
    for half in (changes.where(~older), changes.where(older)):
        half.write.mode("append").parquet(f"{root}/in")
        count_stream(cdc_stream.change_stream(spark, f"{root}/in", changes.schema), table, f"{root}/checkpoint").awaitTermination()
    return table.counts().drop("interval_end")
