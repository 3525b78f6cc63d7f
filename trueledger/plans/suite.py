"""The whole validation suite as one relation.

All counts, sums, NULL counts and date ends of a table come from a single aggregate per side. References
are one more scan per child table; only duplicates and distributions need jobs of their own.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trueledger.functions.finance import PASS, PASS_MINOR, REVIEW, status_below
from trueledger.operators import business, integrity, schema_checks, statistical
from trueledger.operators.structural import COUNT_TOLERANCE
from trueledger.schemas import CHECK_RESULT, FOREIGN_KEYS, PRIMARY_KEYS, REQUIRED_COLUMNS
from trueledger.session import settled
from trueledger.sources import exports
from trueledger.sources.snapshots import FAILURES, reason
from trueledger.sources.tables import union_all

VALUE_SCALE = 6
VALUE = f"decimal(38,{VALUE_SCALE})"
RESULT = ["check_id", "category", "entity", "metric", "expected", "actual", "status", "detail"]
CATEGORIES = ["structural", "schema", "integrity", "business", "statistical"]


@dataclass(frozen=True)
class Measure:
    """One aggregate of a table. ``rule``: the target must equal the source, or be below a limit."""

    check_id: str
    category: str
    metric: str
    value: str
    rule: str = "equal"
    passing: int = 1
    minor: int = 0


def table_measures(name: str, schema: T.StructType) -> list[Measure]:
    """Every single-pass check that applies to a table."""
    out = [Measure("V-01", "structural", "row_count", "count(1)", minor=COUNT_TOLERANCE.get(name, 0))]
    for c in REQUIRED_COLUMNS.get(name, []):
        out.append(Measure("V-13", "integrity", f"required_nulls:{c}", f"count_if({c} IS NULL)", "below"))
    for field in schema.fields:
        c = field.name
        out.append(Measure("V-14", "statistical", f"nulls:{c}", f"count_if({c} IS NULL)"))
        if isinstance(field.dataType, T.DecimalType):
            out.append(Measure("V-24", "statistical", f"sum:{c}", f"sum({c})"))
            scale = field.dataType.scale
            if scale > VALUE_SCALE:
                # What a value has beyond the decimals of the results, as a whole number.
                rest = f"({c} % CAST(1e-{VALUE_SCALE} AS DECIMAL({VALUE_SCALE},{VALUE_SCALE})))"
                unit = "1" + "0" * min(18, scale)
                whole = f"CAST({rest} * {unit}BD AS DECIMAL(28,0))" if scale <= 18 else f"xxhash64({rest}) % 1000000007"
                out.append(Measure("V-24", "statistical", f"sum_beyond_{VALUE_SCALE}_decimals:{c}", f"sum({whole})"))
        if isinstance(field.dataType, T.DateType):
            out.append(Measure("V-16", "statistical", f"first_day:{c}", f"unix_date(min({c}))"))
            out.append(Measure("V-16", "statistical", f"last_day:{c}", f"unix_date(max({c}))"))
    if name == "gl_transactions":
        gap = "abs(sum(debit_amount) - sum(credit_amount))"
        out.append(Measure("V-05", "business", "debits_minus_credits", gap, "below", 100, 10_000))
    if name == "budget_actual":
        out.append(Measure("V-18", "business", "wrong_variance", f"count_if({business.WRONG_VARIANCE})", "below"))
    if name == "invoices":
        out.append(Measure("V-19", "business", "paid_but_owing", f"count_if({business.PAID_BUT_OWING})", "below"))
        out.append(Measure("V-19", "business", "open_but_paid", f"count_if({business.OPEN_BUT_PAID})", "below"))
    return out


def measured(name: str, source: DataFrame, target: DataFrame, measures: list[Measure]) -> DataFrame:
    """All measures of a table on both sides, judged."""
    aggregates = [f"CAST({m.value} AS {VALUE}) AS m{i}" for i, m in enumerate(measures)]
    rows = ", ".join(
        f"'{m.check_id}', '{m.category}', '{m.metric}', '{m.rule}', CAST({m.passing} AS {VALUE}), CAST({m.minor} AS {VALUE}), m{i}"
        for i, m in enumerate(measures)
    )
    unpivot = f"stack({len(measures)}, {rows}) AS (check_id, category, metric, rule, passing, minor, value)"

    def side(df: DataFrame, label: str) -> DataFrame:
        return df.selectExpr(*aggregates).selectExpr(f"'{label}' AS side", unpivot)

    both = side(source, "source").unionByName(side(target, "target"))
    of = lambda label: F.max(F.when(F.col("side") == label, F.col("value")))
    pairs = both.groupBy("check_id", "category", "metric", "rule", "passing", "minor").agg(
        of("source").alias("source_value"), of("target").alias("actual")
    )
    equal = F.col("rule") == "equal"
    expected = F.when(equal, F.col("source_value")).otherwise(F.lit(0).cast(VALUE))
    status = (
        F.when(equal & F.col("actual").eqNullSafe(F.col("source_value")), PASS)
        .when(equal & (F.abs(F.col("actual") - F.col("source_value")) < F.col("minor")), PASS_MINOR)
        .when(equal, REVIEW)
        .when(F.col("actual") < F.col("passing"), PASS)
        .when(F.col("actual") < F.col("minor"), PASS_MINOR)
        .otherwise(REVIEW)
    )
    return pairs.select(
        "check_id",
        "category",
        F.lit(name).alias("entity"),
        "metric",
        expected.alias("expected"),
        "actual",
        status.alias("status"),
        F.lit(None).cast("string").alias("detail"),
    )


def _result(df: DataFrame, check_id: str, category: str, entity, metric: str, actual: Column, status: Column, detail: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(check_id).alias("check_id"),
        F.lit(category).alias("category"),
        (F.lit(entity) if isinstance(entity, str) else entity).alias("entity"),
        F.lit(metric).alias("metric"),
        F.lit(0).cast(VALUE).alias("expected"),
        actual.cast(VALUE).alias("actual"),
        status.alias("status"),
        (F.lit(None) if detail is None else detail).cast("string").alias("detail"),
    )


def _zero(actual: Column) -> Column:
    return F.when(actual == 0, PASS).otherwise(REVIEW)


def reference_results(target: dict[str, DataFrame]) -> list[DataFrame]:
    """All references at once: each child is read once however many it has, its rows summed by key first."""
    children: dict[str, list] = {}
    for fk in FOREIGN_KEYS:
        children.setdefault(fk.child, []).append(fk)
    used = [
        target[child].select(F.explode(F.array(*[F.struct(F.lit(fk.name).alias("reference"), F.col(fk.column).cast("string").alias("key")) for fk in fks])).alias("k")).select("k.*")
        for child, fks in children.items()
    ]
    per_key = union_all([df.groupBy("reference", "key").agg(F.count(F.lit(1)).alias("row_count")) for df in used])
    known = union_all([target[fk.parent].select(F.lit(fk.name).alias("reference"), F.col(fk.column).cast("string").alias("key")) for fk in FOREIGN_KEYS])
    orphans = per_key.join(known, ["reference", "key"], "left_anti").groupBy("reference")
    counted = orphans.agg(F.sum("row_count").alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys"))
    every = target[FOREIGN_KEYS[0].child].sparkSession.createDataFrame([(fk.name,) for fk in FOREIGN_KEYS], "reference string")
    checked = every.join(counted, "reference", "left").select(
        "reference", F.coalesce("orphan_rows", F.lit(0)).alias("orphan_rows"), F.coalesce("orphan_keys", F.lit(0)).alias("orphan_keys")
    )
    status = status_below(F.col("orphan_rows"), 1, 100)
    detail = F.concat(F.col("orphan_keys").cast("string"), F.lit(" keys"))
    return [_result(checked, "V-11", "integrity", F.col("reference"), "orphan_rows", F.col("orphan_rows"), status, detail)]


def duplicate_results(target: dict[str, DataFrame]) -> list[DataFrame]:
    out = []
    for name, df in target.items():
        found = integrity.duplicate_summary(name, df, PRIMARY_KEYS[name])
        out.append(_result(found, "V-17", "integrity", name, "duplicate_keys", F.col("duplicate_keys"), F.col("status")))
    return out


def schema_results(spark: SparkSession, source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    drift = schema_checks.schema_drift(spark, source, target)
    tables = spark.createDataFrame([(name,) for name in source], "table_name string")
    per_table = tables.join(drift, "table_name", "left").groupBy("table_name").agg(F.count("drift").alias("n"))
    return _result(per_table, "V-04", "schema", F.col("table_name"), "drifted_columns", F.col("n"), _zero(F.col("n")))


def distribution_results(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> list[DataFrame]:
    out = []
    for table, column in (("invoices", "status"), ("vendors", "payment_terms")):
        worst = statistical.distribution_gap(source[table], target[table], column).agg(F.max("gap").alias("gap"))
        status = F.when(F.col("gap") < 1, PASS).otherwise(REVIEW)
        out.append(_result(worst, "V-22", "statistical", table, f"largest_share_gap:{column}", F.col("gap"), status))
    return out


def run_suite(spark: SparkSession, source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """Every check on every table, one uniform relation."""
    parts = [measured(name, df, target[name], table_measures(name, df.schema)) for name, df in source.items()]
    parts.append(schema_results(spark, source, target))
    parts += reference_results(target) + duplicate_results(target) + distribution_results(source, target)
    return union_all(parts).select(*RESULT)


def summary(results: DataFrame) -> DataFrame:
    """Checks, passes and pass rate per category."""
    ok = F.count_if(F.col("status") != REVIEW)
    total = F.count(F.lit(1))
    return results.groupBy("category").agg(
        total.alias("checks"),
        ok.alias("passed"),
        F.count_if(F.col("status") == REVIEW).alias("failed"),
        F.round(ok.cast("decimal(20,0)") * 100 / total, 2).cast("decimal(5,2)").alias("pass_rate"),
    )


def check_parts(spark: SparkSession, source: dict[str, DataFrame], target: dict[str, DataFrame]) -> dict[str, list[DataFrame]]:
    """check_id -> what it consists of, each check by itself and reading only the columns it needs."""
    parts: dict[str, list[DataFrame]] = {}
    for name, df in source.items():
        by_check: dict[str, list[Measure]] = {}
        for m in table_measures(name, df.schema):
            by_check.setdefault(m.check_id, []).append(m)
        for check_id, measures in by_check.items():
            parts.setdefault(check_id, []).append(measured(name, df, target[name], measures))
    parts["V-04"] = [schema_results(spark, source, target)]
    parts["V-11"] = reference_results(target)
    parts["V-17"] = duplicate_results(target)
    parts["V-22"] = distribution_results(source, target)
    return parts


def run_logged(spark: SparkSession, source: dict[str, DataFrame], target: dict[str, DataFrame], log: str, run_id: str, run_ts: dt.datetime | None = None) -> DataFrame:
    """Run the suite check by check and append its results to the run log below ``log``.

    Returns the rows that were added: the results with ``run_id``, ``run_ts`` (UTC) and the seconds
    their check took. A check that cannot run is logged as one row to be reviewed, the others go on.
    """
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    done = []
    for check_id, frames in sorted(check_parts(spark, source, target).items()):
        started = time.monotonic()
        try:
            found = settled(union_all(frames).select(*RESULT), f"suite-{check_id}")
        except FAILURES as e:
            row = (check_id, None, "check", "ran", None, None, REVIEW, reason(e))
            found = spark.createDataFrame([row], CHECK_RESULT)
        done.append(found.withColumn("seconds", F.lit(round(time.monotonic() - started, 3))))
    at = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    rows = union_all(done).select(F.lit(run_id).alias("run_id"), at.alias("run_ts"), *RESULT, "seconds")
    exports.append_log(rows, log, "run_ts")
    return rows


def violations(target: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The failing records of each check, as ``entity, record`` relations; nothing runs until used."""
    gl, inv, bud = target["gl_transactions"], target["invoices"], target["budget_actual"]

    def rows(df: DataFrame, entity: str, key: str) -> DataFrame:
        return df.select(F.lit(entity).alias("entity"), F.coalesce(F.col(key).cast("string"), F.lit("NULL")).alias("record"))

    found = {
        f"V-11 {fk.name}": rows(
            integrity.orphan_rows(target[fk.child], [fk.column], target[fk.parent]), fk.child, PRIMARY_KEYS[fk.child][0]
        )
        for fk in FOREIGN_KEYS
    }
    for name, df in target.items():
        key = PRIMARY_KEYS[name]
        found[f"V-17 {name}"] = rows(integrity.duplicate_keys(df, key), name, key[0])
    required = REQUIRED_COLUMNS["gl_transactions"]
    found["V-13 gl_transactions"] = rows(gl.where(integrity.any_null(required)), "gl_transactions", "transaction_id")
    found["V-18 budget_actual"] = rows(bud.where(business.WRONG_VARIANCE), "budget_actual", "budget_id")
    found["V-19 paid_but_owing"] = rows(inv.where(business.PAID_BUT_OWING), "invoices", "invoice_id")
    found["V-19 open_but_paid"] = rows(inv.where(business.OPEN_BUT_PAID), "invoices", "invoice_id")
    return found


def drill_down(target: dict[str, DataFrame]) -> DataFrame:
    """All failing records of all checks."""
    return union_all([df.select(F.lit(name).alias("check_name"), "*") for name, df in violations(target).items()])
