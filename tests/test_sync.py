import datetime as dt
import os
import random
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal as D

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trueledger.operators import cdc, diff, evolve
from trueledger.plans import monitoring
from trueledger.sources import files, generate
from trueledger.sources.change_table import ChangeTable
from trueledger.streaming import cdc_stream
from trueledger.streaming.change_counts import CountTable, change_counts, count_stream

CHANGES = "k int, v string, op string, seq bigint, tie bigint"
KEYS = ["k"]


def changes(spark, *data):
    return spark.createDataFrame([(k, v, op, seq, seq) for k, v, op, seq in data], CHANGES)


def test_last_change_wins_whatever_the_order(spark):
    data = [(1, "a", "I", 1), (1, "b", "U", 3), (1, "c", "U", 2), (2, "x", "I", 1), (2, None, "D", 5), (2, "late", "U", 4), (3, "y", "I", 6)]
    for _ in range(3):
        random.shuffle(data)
        assert rows(cdc.live_rows(cdc.apply_changes(None, changes(spark, *data), KEYS))) == [(1, "b"), (3, "y")]


def test_insert_after_delete_revives(spark):
    df = changes(spark, (1, "a", "I", 1), (1, None, "D", 2), (1, "again", "I", 3))
    assert rows(cdc.live_rows(cdc.apply_changes(None, df, KEYS))) == [(1, "again")]


def test_tie_decides_equal_times(spark):
    df = spark.createDataFrame([(1, "first", "I", 5, 1), (1, "second", "U", 5, 2)], CHANGES)
    assert rows(cdc.live_rows(cdc.apply_changes(None, df, KEYS))) == [(1, "second")]


def random_changes(spark, n=400, seed=7):
    rng = random.Random(seed)
    return changes(spark, *[(rng.randrange(20), f"v{i}", rng.choice("IUUD"), i) for i in range(n)])


def test_batching_and_replay_do_not_matter(spark, folder):
    df = random_changes(spark)
    want = rows(cdc.live_rows(cdc.apply_changes(None, df, KEYS)))
    table = ChangeTable(spark, folder, KEYS, buckets=4)
    parts = [df.where(F.col("seq") % 3 == i) for i in range(3)]
    for part in [parts[2], parts[0], parts[1], parts[0]]:
        table.apply(part)
    assert rows(table.live()) == want
    table.fold()
    assert rows(table.live()) == want and all(len(names) == 1 for names in table.batches().values())


def test_only_touched_buckets_are_rewritten(spark, folder):
    table = ChangeTable(spark, folder, KEYS, buckets=16, fold_after=1)
    table.apply(random_changes(spark))
    before = table.batches()
    touched = table.apply(changes(spark, (1, "new", "U", 10_000)))
    after = table.batches()
    assert len(touched) == 1 and {b for b in after if after[b] != before[b]} == set(touched)
    assert all(len(names) == 1 for names in after.values())
    assert table.live().where("k = 1").first().v == "new"


def test_buckets_of_one_batch_are_read_as_they_are(spark, folder):
    table = ChangeTable(spark, folder, KEYS, buckets=8)
    table.apply(random_changes(spark))
    assert "Exchange" not in table.live()._jdf.queryExecution().executedPlan().toString()


def test_a_batch_that_was_not_finished_is_not_seen(spark, folder):
    table = ChangeTable(spark, folder, KEYS, buckets=2, fold_after=2)
    table.apply(changes(spark, (1, "a", "I", 1)))
    half = changes(spark, (1, "half", "U", 2))
    name = table._append(half)
    os.remove(f"{folder}/batch={name}/_SUCCESS")  # as a job leaves it that dies
    assert rows(table.live()) == [(1, "a")]
    for seq in range(3, 8):
        table.apply(changes(spark, (1, f"v{seq}", "U", seq)))
    assert rows(table.live()) == [(1, "v7")] and os.path.exists(f"{folder}/batch={name}")


def test_a_fold_that_dies_leaves_the_same_table(spark, folder, monkeypatch):
    df = random_changes(spark)
    want = rows(cdc.live_rows(cdc.apply_changes(None, df, KEYS)))
    table = ChangeTable(spark, folder, KEYS, buckets=3)
    for i in range(3):
        table.apply(df.where(F.col("seq") % 3 == i))
    removed = []
    monkeypatch.setattr(files, "remove", lambda spark, path: removed.append(path) if len(removed) < 2 else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.fold()  # the folded batch is there, and so are all that it was made of
    monkeypatch.undo()
    assert rows(table.live()) == want
    table.fold()
    assert rows(table.live()) == want and all(len(names) == 1 for names in table.batches().values())


def test_new_columns_arrive_with_the_changes(spark, folder):
    table = ChangeTable(spark, folder, KEYS, buckets=4)
    table.apply(changes(spark, *[(k, "old", "I", 1) for k in range(8)]))
    wider = changes(spark, (1, "new", "U", 2)).withColumn("notes", F.lit("n"))
    table.apply(wider.limit(0))
    assert "notes" not in table.live().columns  # no data, no schema change
    table.apply(wider)
    assert rows(table.live().where("k < 3").select("k", "v", "notes")) == [(0, "old", None), (1, "new", "n"), (2, "old", None)]
    table.apply(changes(spark, (2, "newer", "U", 3)))
    assert rows(table.live().where("k IN (1, 2)").select("k", "v", "notes")) == [(1, "new", "n"), (2, "newer", None)]
    with pytest.raises(evolve.SchemaEvolutionError):
        table.apply(changes(spark, (1, "x", "U", 9)).withColumn("notes", F.lit(5)))
    table.fold()
    assert rows(table.live().where("k IN (1, 2)").select("k", "v", "notes")) == [(1, "new", "n"), (2, "newer", None)]


def test_empty_batch_changes_nothing(spark, folder):
    table = ChangeTable(spark, folder, KEYS)
    assert table.apply(random_changes(spark).limit(0)) == [] and table.live() is None and os.listdir(folder) == []
    table.fold()


def test_null_key_is_a_key_however_often_it_is_replayed(spark, folder):
    batch = changes(spark, (None, "a", "I", 1), (1, "b", "I", 1))
    table = ChangeTable(spark, folder, KEYS, buckets=4)
    for _ in range(3):
        table.apply(batch)
    assert rows(table.live()) == [(1, "b"), (None, "a")]
    once = cdc.apply_changes(None, batch, KEYS)
    assert rows(cdc.live_rows(cdc.apply_changes(cdc.apply_changes(once, batch, KEYS), batch, KEYS))) == [(1, "b"), (None, "a")]


def test_two_writers_at_the_same_time(spark, folder):
    """Neither waits for the other, both fold, and nothing is lost."""
    df = random_changes(spark, 300)
    want = rows(cdc.live_rows(cdc.apply_changes(None, df, KEYS)))

    def write(half):
        table = ChangeTable(spark, folder, KEYS, buckets=2, fold_after=100)
        for i in range(4):
            table.apply(df.where((F.col("seq") % 2 == half) & (F.col("seq") % 8 < 2 * i + 2) & (F.col("seq") % 8 >= 2 * i)))

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, [0, 1]))
    table = ChangeTable(spark, folder, KEYS, buckets=2)
    assert rows(table.live()) == want
    table.fold()
    assert rows(table.live()) == want


def test_changes_of_equal_order_give_one_result(spark, folder):
    tied = [spark.createDataFrame([(1, v, "U", 5, 0)], CHANGES) for v in ("x", "y", "z")]
    found = set()
    for n, order in enumerate([tied, tied[::-1], [tied[1], tied[0], tied[2], tied[1]]]):
        table = ChangeTable(spark, f"{folder}/{n}", KEYS, buckets=1)
        for batch in order:
            table.apply(batch)
        found.add(table.live().first().v)
    assert len(found) == 1


def test_a_batch_costs_what_it_holds_and_disk_stays_bounded(spark, folder):
    table = ChangeTable(spark, folder, KEYS, buckets=4, fold_after=3)
    table.apply(spark.range(5_000).selectExpr("int(id) AS k", "'old' AS v", "'I' AS op", "id * 0 + 1 AS seq", "0L AS tie"))
    for seq in range(2, 26):
        table.apply(changes(spark, (seq % 3, f"v{seq}", "U", seq)))
        held = table.batches()
        assert all(len(names) <= 4 for names in held.values())
        assert set(os.listdir(folder)) == {f"batch={name}" for names in held.values() for name in names}
    live = table.live()
    assert live.count() == 5_000 and rows(live.where("v <> 'old'")) == [(0, "v24"), (1, "v25"), (2, "v23")]


def test_tombstones_can_be_purged(spark):
    state = cdc.apply_changes(None, changes(spark, (1, "a", "D", 1), (2, "b", "D", 9), (3, "c", "I", 1)), KEYS)
    assert rows(cdc.purge_tombstones(state, 5).select("k")) == [(2,), (3,)]


def test_stream_equals_batch_and_survives_a_restart(spark, folder):
    df = random_changes(spark)
    want = rows(cdc.live_rows(cdc.apply_changes(None, df, KEYS)))
    source = f"{folder}/in"
    table = ChangeTable(spark, f"{folder}/state", KEYS, buckets=4)
    for i in range(4):
        df.where(F.col("seq") % 4 == i).coalesce(1).write.mode("append").parquet(source)
        if i % 2:
            stream = cdc_stream.change_stream(spark, source, df.schema, max_files=1)
            cdc_stream.apply_stream(stream, table, f"{folder}/checkpoint").awaitTermination()
    assert rows(table.live()) == want


def timed_events(spark, n=2000):
    start = dt.datetime(2024, 1, 1)
    data = [(i % 7, "IUD"[i % 3], start + dt.timedelta(minutes=3 * i), i) for i in range(n)]
    return spark.createDataFrame(data, "k int, op string, seq timestamp_ntz, tie bigint")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_streamed_counts_equal_batch_counts(spark, folder, zone, kind):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        compare_streamed_counts(spark, folder, kind)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def compare_streamed_counts(spark, folder, kind):
    """Files days out of order, counted over a restart and over folds: nothing is lost, the late ones are known."""
    df = timed_events(spark, 2_400).withColumn("seq", F.col("seq").cast(kind))
    df = df.unionByName(df.limit(5).withColumn("seq", F.lit(None).cast(kind)))
    want = rows(change_counts(df, "1 day"))
    table = CountTable(spark, f"{folder}/counts", "1 day", "1 hour", fold_after=2)
    order = [1, 0, 5, 3, 4, 2]
    for half in (order[:3], order[3:]):
        for i in half:
            part = F.coalesce(F.floor(F.col("tie") / 400) == i, F.lit(False)) & F.col("seq").isNotNull()
            df.where(part if i else part | F.col("seq").isNull()).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        count_stream(cdc_stream.change_stream(spark, f"{folder}/in", df.schema, max_files=1), table, f"{folder}/checkpoint").awaitTermination()
    found = table.counts(kind)
    assert rows(found.drop("late_count")) == want
    # All of parts 0, 3, 4 and 2: 400 changes of 3 minutes are 20 hours, more than the hour allowed.
    assert found.agg(F.sum("late_count")).first()[0] == 4 * 400
    assert len(os.listdir(f"{folder}/counts/batches")) <= 2 * 4  # folders, and their checksums where there are some


def test_a_replayed_count_replaces_itself(spark, folder):
    df = timed_events(spark, 600)
    table = CountTable(spark, folder, "1 day", fold_after=1)
    parts = [df.where(f"tie % 4 = {i}") for i in range(4)]
    for number in (0, 1, 1, 2, 2, 3, 3, 3):
        table.add(parts[number], number)
    assert rows(table.counts().drop("late_count")) == rows(change_counts(df, "1 day"))


def test_insert_then_update_batch(spark):
    fin = generate.generate(spark, {"chart_of_accounts": 20, "cost_centers": 10, "vendors": 30, "budget_actual": 20, "invoices": 500, "gl_transactions": 20})
    day = F.lit(dt.date(2024, 6, 1))
    order = lambda df, op, seq: df.select("*", F.lit(op).alias("op"), F.lit(seq).alias("seq"), F.lit(0).cast("bigint").alias("tie"))
    new = generate.test_invoices(spark, F.lit(500).cast("bigint"), 100, day)
    inserted = cdc.apply_changes(cdc.as_state(fin["invoices"], 0), order(new, "I", 1), ["invoice_id"])
    live = cdc.live_rows(inserted)
    assert live.count() == 600
    paid = generate.mark_even_paid(live, day)
    final = cdc.live_rows(cdc.apply_changes(inserted, order(paid, "U", 2), ["invoice_id"]))
    test_rows = final.where(F.col("invoice_number").like("INV-TEST-%"))
    assert rows(test_rows.groupBy("status").count()) == [("Open", 50), ("Paid", 50)]
    assert test_rows.where("status = 'Paid' AND (paid_amount <> invoice_amount OR outstanding_amount <> 0 OR payment_date IS NULL)").count() == 0
    assert new.where("vendor_id BETWEEN 1 AND 1000 AND invoice_amount BETWEEN 1000 AND 50000 AND cost_center BETWEEN 'CC1000' AND 'CC1199'").count() == 100


ROWS = "k int, name string, amount decimal(18,2), day date"
A = [(1, "a", D("1.00"), None), (2, "b", D("2.00"), dt.date(2024, 1, 1)), (3, "c", None, None), (4, "d", D("4.00"), None)]


def test_diff_names_every_defect(spark):
    source = spark.createDataFrame(A, ROWS)
    target = spark.createDataFrame([(1, "a", D("1.00"), None), (1, "a", D("1.00"), None), (2, "B", D("2.01"), None), (3, None, None, None), (9, "z", None, None)], ROWS)
    assert rows(diff.key_differences(source, target, KEYS)) == [(1, 1, 2, "DUPLICATE"), (2, 1, 1, "CHANGED"), (3, 1, 1, "CHANGED"), (4, 1, 0, "MISSING"), (9, 0, 1, "EXTRA")]
    cells = {(r.k, r.difference, r.column_name, r.source_value, r.target_value) for r in diff.cell_differences(source, target, KEYS).collect()}
    assert cells == {
        (1, "DUPLICATE", None, None, None),
        (2, "CHANGED", "name", "b", "B"),
        (2, "CHANGED", "amount", "2.00", "2.01"),
        (2, "CHANGED", "day", "2024-01-01", None),
        (3, "CHANGED", "name", "c", None),
        (4, "MISSING", None, None, None),
        (9, "EXTRA", None, None, None),
    }
    close = diff.cell_differences(source, target, KEYS, tolerance={"amount": "0.01"}).where("column_name = 'amount'")
    assert close.count() == 0
    assert diff.key_differences(source, source, KEYS).count() == 0


def test_diff_with_null_and_composite_keys(spark):
    ddl = "a int, b string, v int"
    source = spark.createDataFrame([(None, "x", 1), (1, None, 2), (1, "y", 3)], ddl)
    target = spark.createDataFrame([(None, "x", 9), (1, None, 2), (1, "y", 4)], ddl)
    cells = {(r.a, r.b, r.column_name, r.source_value, r.target_value) for r in diff.cell_differences(source, target, ["a", "b"]).collect()}
    assert cells == {(None, "x", "v", "1", "9"), (1, "y", "v", "3", "4")}


def test_diff_compares_the_columns_both_sides_have(spark):
    source = spark.createDataFrame([(1, "a", 1)], "k int, v string, lost int")
    target = spark.createDataFrame([(1, "b", "n")], "k int, v string, notes string")
    assert [r.column_name for r in diff.cell_differences(source, target, KEYS).collect()] == ["v"]


def test_equal_duplicates_are_no_difference(spark):
    twice = spark.createDataFrame(A + A, ROWS)
    assert diff.key_differences(twice, twice.repartition(3), KEYS).count() == 0


def test_null_position_matters(spark):
    ddl = "k int, a bigint, b bigint"
    source, target = spark.createDataFrame([(1, None, 1)], ddl), spark.createDataFrame([(1, 1, None)], ddl)
    assert diff.key_differences(source, target, KEYS).first().difference == "CHANGED"
    assert not diff.same_content(source, target, "t").first().same
    assert diff.fingerprint(source, "t").first() != diff.fingerprint(target, "t").first()


@pytest.mark.parametrize("fingerprint", [diff.fingerprint, diff.fast_fingerprint])
def test_fingerprint(spark, fingerprint):
    df = spark.createDataFrame(A, ROWS)
    assert fingerprint(df, "t").first() == fingerprint(df.repartition(5).orderBy("name"), "t").first()
    assert fingerprint(df, "t").first() != fingerprint(df.unionByName(df), "t").first()
    pairs = spark.createDataFrame([A[0], A[0]], ROWS), spark.createDataFrame([A[1], A[1]], ROWS)
    assert fingerprint(pairs[0], "t").first() != fingerprint(pairs[1], "t").first()
    fingerprint(df.limit(0), "t").first()


def test_text_cannot_be_shifted_between_columns(spark):
    ddl = "a string, b string"
    one, other = spark.createDataFrame([("x2:", "y")], ddl), spark.createDataFrame([("x", "2:y")], ddl)
    assert diff.fingerprint(one, "t").first() != diff.fingerprint(other, "t").first()


def test_scale_is_no_difference(spark):
    source = spark.createDataFrame(A, ROWS)
    target = source.withColumn("amount", F.col("amount").cast("decimal(20,4)"))
    assert diff.key_differences(source, target, KEYS).count() == 0


def test_evolution(spark):
    old = spark.createDataFrame([(1, "a")], "id int, name string")
    new = spark.createDataFrame([(2, "b", "n")], "id int, name string, notes string")
    assert rows(evolve.evolve(old, new)) == [(1, "a", None), (2, "b", "n")]
    assert rows(evolve.evolve(evolve.evolve(old, new), old))[0] == (1, "a", None)
    with pytest.raises(evolve.SchemaEvolutionError, match="id: int cannot become bigint"):
        evolve.evolve(old, new.withColumn("id", F.col("id").cast("bigint")))


@pytest.mark.parametrize(
    "source, target",
    [
        ("NUMBER(38,0)", "bigint"),
        ("NUMBER(10, 2)", "decimal(10,2)"),
        ("VARCHAR(500)", "string"),
        ("DATE", "date"),
        ("TIMESTAMP_NTZ", "timestamp_ntz"),
        ("BOOLEAN", "boolean"),
    ],
)
def test_type_names(source, target):
    assert evolve.target_type(source) == target


@pytest.mark.parametrize("name", ["VARIANT", "GEOGRAPHY", "GEOMETRY", "XML"])
def test_types_without_counterpart(name):
    with pytest.raises(evolve.UnsupportedTypeError):
        evolve.target_type(name)


def test_casts_and_their_losses(spark):
    df = spark.createDataFrame([(1, "7", 1.25), (300, "x", 2.0), (None, None, None)], "n int, s string, d double")
    rules = {"n": "tinyint", "s": "int", "d": "decimal(4,1)"}
    assert rows(evolve.map_types(df, rules))[0][0] == 1
    got = {r.column_name: (r["values"], r.not_fitting, r.altered) for r in evolve.cast_losses(df, rules).collect()}
    assert got == {"n": (2, 1, 0), "s": (2, 1, 0), "d": (2, 0, 1)}


@pytest.mark.parametrize("kind, a, b", [("decimal(20,8)", "1.00000001", "1.00000002"), ("decimal(38,18)", "-7.000000000000000001", "-7.000000000000000002"), ("decimal(38,38)", "0.00000000000000000000000000000000000001", "0.00000000000000000000000000000000000002"), ("decimal(38,0)", "9" * 36 + "1", "9" * 36 + "2")])
def test_every_decimal_counts(spark, kind, a, b):
    left = spark.createDataFrame([(1, a)], "k int, v string").withColumn("v", F.col("v").cast(kind))
    right = spark.createDataFrame([(1, b)], "k int, v string").withColumn("v", F.col("v").cast(kind))
    assert diff.same_content(left, left, "t").first().same and not diff.same_content(left, right, "t").first().same
    assert rows(diff.key_differences(left, right, ["k"])) == [(1, 1, 1, "CHANGED")]


def test_a_wider_scale_is_no_difference(spark):
    base = spark.createDataFrame([(1, "1.5"), (2, "-2.25"), (3, None)], "k int, v string")
    kinds = ["decimal(20,8)", "decimal(20,10)", "decimal(38,30)", "decimal(12,2)"]
    for a in kinds:
        for b in kinds:
            left, right = (base.withColumn("v", F.col("v").cast(kind)) for kind in (a, b))
            assert diff.same_content(left, right, "t").first().same, (a, b)
            assert diff.fast_fingerprint(left, "t").first() == diff.fast_fingerprint(right, "t").first()


def test_tolerance_holds_for_repeated_keys_and_small_values(spark):
    left = spark.createDataFrame([(1, "1.00"), (1, "1.00"), (2, "5.0"), (3, None)], "k int, v string").withColumn("v", F.col("v").cast("decimal(20,9)"))
    right = spark.createDataFrame([(1, "1.01"), (1, "1.01"), (2, "5.0000003"), (3, None)], "k int, v string").withColumn("v", F.col("v").cast("decimal(20,9)"))
    assert rows(diff.key_differences(left, right, ["k"], tolerance={"v": "0.25"})) == []
    assert [r[0] for r in rows(diff.key_differences(left, right, ["k"], tolerance={"v": "0.0000001"}))] == [1, 2]
    assert [r[0] for r in rows(diff.key_differences(left, right, ["k"], tolerance={"v": "0.0000004"}))] == [1]


def test_tolerance_pairs_the_rows_of_a_repeated_key(spark):
    kind = "k int, s string, a decimal(18,2), b decimal(18,2)"

    def found(left, right, **tolerance):
        sides = [spark.createDataFrame([(k, s, None if a is None else D(str(a)), None if b is None else D(str(b))) for k, s, a, b in side], kind) for side in (left, right)]
        return rows(diff.key_differences(*sides, ["k"], tolerance=tolerance or {"a": "0.25", "b": "0.25"}))

    row = lambda *values, k=1: [(k, "x", v, 0) for v in values]
    assert found(row(0, 5, 10), row(0, 1, 10)) == [(1, 3, 3, "DUPLICATE")]  # a value between the ends
    assert found(row(0, 5, 10), row(10, "5.2", "0.1")) == []
    assert found(row(0, None, 10), row(0, 10, None)) == [] and len(found(row(0, None, 10, 5), row(0, 10, None, 6))) == 1
    # The values of two columns swapped between two rows of a key, and rows swapped whole.
    assert found([(1, "x", 1, 10), (1, "x", 5, 20)], [(1, "x", 1, 20), (1, "x", 5, 10)]) == [(1, 2, 2, "DUPLICATE")]
    assert found([(1, "x", 1, 10), (1, "x", 5, 20)], [(1, "x", 5, 20), (1, "x", "1.1", 10)]) == []
    # Tolerant values belong to the rows with the same other columns.
    assert found([(1, "x", 1, 0), (1, "y", 5, 0)], [(1, "x", 5, 0), (1, "y", 1, 0)]) == [(1, 2, 2, "DUPLICATE")]
    assert found([(None, "x", 1, 0), (None, "x", 2, 0), (None, "x", 9, 0)], [(None, "x", 1, 0), (None, "x", 3, 0), (None, "x", 9, 0)]) == [(None, 3, 3, "DUPLICATE")]
    many = [(7, "x", i % 50, i % 3) for i in range(600)]
    assert found(many, [(k, s, a + 0.2, b) for k, s, a, b in many]) == []
    assert found(many, [(k, s, a + (0.3 if a == 20 else 0), b) for k, s, a, b in many]) == [(7, 600, 600, "DUPLICATE")]
    # Without a tolerance nothing changes.
    assert diff.key_differences(*[spark.createDataFrame([(1, "x", D(1), D(v)), (1, "x", D(2), D(v))], kind) for v in (1, 2)], ["k"]).count() == 1


def test_a_stream_logs_its_runs(spark, folder):
    df = random_changes(spark)
    df.coalesce(1).write.parquet(f"{folder}/in")
    table = ChangeTable(spark, f"{folder}/state", KEYS, buckets=2)
    stream = cdc_stream.change_stream(spark, f"{folder}/in", df.schema)
    cdc_stream.apply_stream(stream, table, f"{folder}/checkpoint", log=f"{folder}/log", name="accounts").awaitTermination()
    (run,) = spark.read.parquet(f"{folder}/log").collect()
    assert (run.run_id, run.table_name, run.rows_synced, run.error) == (0, "accounts", 400, None) and run.sync_start <= run.sync_end
    status = monitoring.sync_status(spark.read.parquet(f"{folder}/log")).first()
    assert status.last_rows == 400 and status.failed_syncs == 0
    df.withColumn("v", F.lit(1)).write.mode("append").parquet(f"{folder}/typed")  # the same column with another type
    other = cdc_stream.change_stream(spark, f"{folder}/typed", df.withColumn("v", F.lit(1)).schema)
    with pytest.raises(Exception, match="cannot become"):
        cdc_stream.apply_stream(other, table, f"{folder}/checkpoint2", log=f"{folder}/log", name="accounts").awaitTermination()
    outcomes = monitoring.sync_outcomes(spark.read.parquet(f"{folder}/log"))
    assert rows(outcomes.select("failed")) == [(False,), (True,)]
    assert monitoring.open_alerts(monitoring.alert_states(spark, outcomes)).count() == 1
