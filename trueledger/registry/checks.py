"""Validation checks by name. Most run on the source and on a faulty copy of it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trueledger.operators import business as B
from trueledger.operators import integrity as I
from trueledger.operators import schema_checks as S
from trueledger.operators import statistical as ST
from trueledger.operators import structural as STR
from trueledger.plans import monitoring, suite
from trueledger.registry import query
from trueledger.registry.ctes import BANDS, PERCENT, SPANS, cents, exact_ratio, scaled, with_views
from trueledger.schemas import FOREIGN_KEYS, PRIMARY_KEYS, REQUIRED_COLUMNS, TABLES
from trueledger.session import work_dir
from trueledger.sources import exports, tables
from trueledger.sources import testviews as V
from trueledger.sources.tables import union_all

# finance table -> SQL view of the source side; the copy's view has the prefix t_
SQL_NAME = {
    "chart_of_accounts": "coa",
    "cost_centers": "cc",
    "vendors": "vendors",
    "budget_actual": "bud",
    "invoices": "inv",
    "gl_transactions": "gl",
}
SOURCE_VIEWS = " ".join(SQL_NAME.values())
DECIMALS = [(t, f) for t, schema in TABLES.items() for f in schema.fields if f.dataType.typeName() == "decimal"]
COPY_VIEWS = " ".join(f"t_{v}" for v in SQL_NAME.values())


def both(fn: Callable[[dict[str, DataFrame]], DataFrame], gl_columns=None):
    """A query that runs ``fn`` on the source tables and on the faulty copy."""

    def run(spark, sf_dir):
        source = V.finance(spark, sf_dir, gl_columns)
        sides = (("source", source), ("copy", V.faulty(source)))
        return union_all([fn(fin).select(F.lit(side).alias("side"), "*") for side, fin in sides])

    return run


def both_sql(views: str, body: str) -> str:
    """``body`` with {gl}, {inv}, ... filled in for either side."""
    names = views.split()
    halves = []
    for side, prefix in (("source", ""), ("copy", "t_")):
        halves.append(f"SELECT '{side}' AS side, * FROM ({body.format(**{n: prefix + n for n in names})})")
    return with_views(" ".join(names + [f"t_{n}" for n in names]), " UNION ALL ".join(halves))


def ladder(value: str, passing: str, minor: str) -> str:
    return f"CASE WHEN {value} < {passing} THEN 'PASS' WHEN {value} < {minor} THEN 'PASS_MINOR' ELSE 'REVIEW' END"


NO_LOOKUP = V.LEDGER_ONLY
COUNT_PAIRS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM t_{v}) AS row_count, (SELECT COUNT(*) FROM {v}) AS expected_count, "
    f"{STR.COUNT_TOLERANCE[t]} AS tol"
    for t, v in SQL_NAME.items()
)


def _counted(spark, sf_dir):
    source = V.finance(spark, sf_dir, NO_LOOKUP)
    return V.faulty(source), tables.row_counts(source)


@query(
    "v01_row_count_parity",
    with_views(
        f"{SOURCE_VIEWS} {COPY_VIEWS}",
        f"""SELECT table_name, row_count, expected_count, CASE WHEN row_count = expected_count THEN 'PASS'
        WHEN abs(row_count - expected_count) < tol THEN 'PASS_MINOR' ELSE 'REVIEW' END AS status FROM ({COUNT_PAIRS})""",
    ),
)
def v01(spark, sf_dir):
    return STR.row_count_parity(*_counted(spark, sf_dir))


@query(
    "v01b_strict_row_count",
    with_views(
        f"{SOURCE_VIEWS} {COPY_VIEWS}",
        f"SELECT table_name, row_count, expected_count, CASE WHEN row_count = expected_count THEN 'PASS' ELSE 'FAIL' END AS status FROM ({COUNT_PAIRS})",
    ),
)
def v01b(spark, sf_dir):
    return STR.strict_row_count(*_counted(spark, sf_dir))


@query(
    "v02_dataset_total",
    with_views(
        f"{SOURCE_VIEWS} {COPY_VIEWS}",
        f"""SELECT CAST(SUM(row_count) AS BIGINT) AS total_rows, CAST(SUM(expected_count) AS BIGINT) AS expected_rows,
        CASE WHEN SUM(row_count) >= 80000 THEN 'PASS' ELSE 'REVIEW' END AS status FROM ({COUNT_PAIRS})""",
    ),
)
def v02(spark, sf_dir):
    return STR.dataset_total(*_counted(spark, sf_dir), minimum=80_000)


@query(
    "v03_column_counts",
    with_views(
        f"{SOURCE_VIEWS} {COPY_VIEWS}",
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, CAST({len(TABLES[t].fields)} AS BIGINT) AS column_count, CAST("
            + " + ".join(f"CAST(COUNT({c}) > 0 AS INTEGER)" for c in TABLES[t].names)
            + f" AS BIGINT) AS populated_columns FROM t_{SQL_NAME[t]}"
            for t in TABLES
        ),
    ),
)
def v03(spark, sf_dir):
    return STR.populated_columns(spark, V.faulty(V.finance(spark, sf_dir)))


def _drifted_invoices(inv: DataFrame) -> DataFrame:
    """A copy whose schema has drifted: coarser amount, narrower key, lost and added columns."""
    return inv.select(
        "invoice_id",
        "invoice_number",
        F.col("vendor_id").try_cast("tinyint").alias("vendor_id"),
        "invoice_date",
        "due_date",
        F.col("invoice_amount").cast("decimal(18,1)").alias("invoice_amount"),
        "paid_amount",
        "outstanding_amount",
        "status",
        "cost_center",
        "account_number",
        F.lit("none").alias("notes"),
    )


@query(
    "v04_schema_drift",
    with_views(
        "inv",
        """SELECT 'invoices' AS table_name, column_name, drift, source_type, target_type, source_values, values_altered FROM (
        SELECT 'vendor_id' AS column_name, 'TYPE' AS drift, 'bigint' AS source_type, 'tinyint' AS target_type, COUNT(vendor_id) AS source_values,
          COUNT(*) FILTER (vendor_id NOT BETWEEN -128 AND 127) AS values_altered FROM inv
        UNION ALL SELECT 'invoice_amount', 'TYPE', 'decimal(18,2)', 'decimal(18,1)', COUNT(invoice_amount),
          COUNT(*) FILTER (invoice_amount * 10 <> floor(invoice_amount * 10)) FROM inv
        UNION ALL SELECT 'payment_date', 'MISSING', 'date', NULL, COUNT(payment_date), 0 FROM inv
        UNION ALL SELECT 'notes', 'ADDED', NULL, 'string', NULL, NULL
        UNION ALL SELECT c, 'POSITION', t, t, n, 0 FROM (
          SELECT unnest(['paid_amount','outstanding_amount','status','cost_center','account_number']) AS c,
            unnest(['decimal(18,2)','decimal(18,2)','string','string','string']) AS t,
            unnest([COUNT(paid_amount), COUNT(outstanding_amount), COUNT(status), COUNT(cost_center), COUNT(account_number)]) AS n FROM inv))""",
    ),
)
def v04(spark, sf_dir):
    source = {"invoices": V.invoices(spark, sf_dir)}
    target = {"invoices": _drifted_invoices(source["invoices"])}
    drift = S.drift_impact(spark, source, target)
    # Nullability of derived views is an artefact of their expressions, not of stored data.
    return drift.where("drift <> 'NULLABILITY'")


@query(
    "v05_gl_balance",
    both_sql(
        "gl",
        f"""SELECT total_debits, total_credits, CAST(abs(total_debits - total_credits) AS DECIMAL(28,2)) AS difference,
        {ladder('abs(total_debits - total_credits)', '100', '10000')} AS status FROM (
        SELECT CAST(SUM(debit_amount) AS DECIMAL(28,2)) AS total_debits, CAST(SUM(credit_amount) AS DECIMAL(28,2)) AS total_credits FROM {{gl}})""",
    ),
)
def v05(spark, sf_dir):
    return both(lambda fin: B.gl_balance(fin["gl_transactions"]), NO_LOOKUP)(spark, sf_dir)


@query(
    "v05_balance_report",
    both_sql(
        "gl",
        f"""SELECT format('{{{{:,.2f}}}}', CAST(d AS DOUBLE)) AS total_debits, format('{{{{:,.2f}}}}', CAST(c AS DOUBLE)) AS total_credits,
        format('{{{{:,.2f}}}}', CAST(abs(d - c) AS DOUBLE)) AS difference, {ladder('abs(d - c)', '100', '1000000000')} AS status
        FROM (SELECT SUM(debit_amount) AS d, SUM(credit_amount) AS c FROM {{gl}})""",
    ),
)
def v05_report(spark, sf_dir):
    """The balance formatted for reading, with the wide tolerance used for test data."""
    return both(lambda fin: B.balance_report(B.gl_balance(fin["gl_transactions"], 100, 1_000_000_000)), NO_LOOKUP)(spark, sf_dir)


@query(
    "v06_balance_by_period",
    both_sql(
        "gl",
        """SELECT fiscal_year, fiscal_period, CAST(SUM(debit_amount) AS DECIMAL(28,2)) AS total_debits, CAST(SUM(credit_amount) AS DECIMAL(28,2)) AS total_credits,
        CAST(SUM(debit_amount) - SUM(credit_amount) AS DECIMAL(28,2)) AS net_difference FROM {gl} GROUP BY 1, 2 ORDER BY 1 DESC, 2 DESC LIMIT 12""",
    ),
)
def v06(spark, sf_dir):
    return both(lambda fin: B.balance_by_period(fin["gl_transactions"]), NO_LOOKUP)(spark, sf_dir)


@query(
    "v07_net_by_year",
    both_sql("gl", "SELECT fiscal_year, CAST(SUM(debit_amount) - SUM(credit_amount) AS DECIMAL(28,2)) AS net_balance FROM {gl} GROUP BY 1"),
)
def v07(spark, sf_dir):
    return both(lambda fin: B.net_by_year(fin["gl_transactions"]), NO_LOOKUP)(spark, sf_dir)


def orphan_sql(reference: str, child: str, key: str, parent: str) -> str:
    return f"""SELECT '{reference}' AS reference, COUNT(*) AS orphan_rows, COUNT(DISTINCT c.{key}) + MAX(CASE WHEN c.{key} IS NULL THEN 1 ELSE 0 END) AS orphan_keys
        FROM {{{child}}} c LEFT JOIN {{{parent}}} p ON c.{key} = p.{key} WHERE p.{key} IS NULL"""


@query(
    "v08_orphan_invoices",
    both_sql(
        "inv vendors",
        f"""SELECT reference, orphan_rows, CAST(COALESCE(orphan_keys, 0) AS BIGINT) AS orphan_keys, {ladder('orphan_rows', '1', '100')} AS status
        FROM ({orphan_sql('invoices.vendor_id->vendors', 'inv', 'vendor_id', 'vendors')})""",
    ),
)
def v08(spark, sf_dir):
    name = "invoices.vendor_id->vendors"
    return both(lambda fin: I.foreign_key_check(name, fin["invoices"], ["vendor_id"], fin["vendors"]))(spark, sf_dir)


def coverage_sql(reference: str, child: str, key: str, parent: str) -> str:
    return f"""SELECT '{reference}' AS reference, used_keys, valid_keys, used_keys - valid_keys AS missing_keys,
        {ladder('used_keys - valid_keys', '1', '10')} AS status FROM (
        SELECT COUNT(DISTINCT c.{key}) AS used_keys, COUNT(DISTINCT p.{key}) AS valid_keys
        FROM {{{child}}} c LEFT JOIN {{{parent}}} p ON c.{key} = p.{key})"""


@query("v09_cost_center_coverage", both_sql("gl cc", coverage_sql("gl_transactions.cost_center", "gl", "cost_center", "cc")))
def v09(spark, sf_dir):
    name = "gl_transactions.cost_center"
    return both(lambda fin: I.key_coverage(name, fin["gl_transactions"], "cost_center", fin["cost_centers"]))(spark, sf_dir)


@query("v10_account_coverage", both_sql("gl coa", coverage_sql("gl_transactions.account_number", "gl", "account_number", "coa")))
def v10(spark, sf_dir):
    name = "gl_transactions.account_number"
    run = both(lambda fin: I.key_coverage(name, fin["gl_transactions"], "account_number", fin["chart_of_accounts"]), NO_LOOKUP)
    return run(spark, sf_dir)


@query(
    "v11_foreign_keys",
    both_sql(
        SOURCE_VIEWS,
        f"""SELECT reference, orphan_rows, CAST(COALESCE(orphan_keys, 0) AS BIGINT) AS orphan_keys, {ladder('orphan_rows', '1', '100')} AS status FROM ("""
        + " UNION ALL ".join(orphan_sql(fk.name, SQL_NAME[fk.child], fk.column, SQL_NAME[fk.parent]) for fk in FOREIGN_KEYS)
        + ")",
    ),
)
def v11(spark, sf_dir):
    def check(fin):
        return union_all([I.foreign_key_check(fk.name, fin[fk.child], [fk.column], fin[fk.parent]) for fk in FOREIGN_KEYS])

    return both(check)(spark, sf_dir)


@query(
    "v12_critical_nulls",
    both_sql(
        "gl",
        """SELECT *, CASE WHEN null_ids = 0 AND null_accounts = 0 THEN 'PASS' ELSE 'REVIEW' END AS status FROM (
        SELECT COUNT(*) AS total_rows, COUNT(*) - COUNT(transaction_id) AS null_ids, COUNT(*) - COUNT(account_number) AS null_accounts,
        COUNT(*) FILTER (debit_amount = 0 AND credit_amount = 0) AS zero_amount_rows FROM {gl})""",
    ),
)
def v12(spark, sf_dir):
    return both(lambda fin: I.critical_nulls(fin["gl_transactions"]), NO_LOOKUP)(spark, sf_dir)


def null_sql(view: str, table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT(*) AS total_rows, COUNT(*) - COUNT({c}) AS null_rows FROM {view}" for c in columns
    )


@query(
    "v13_required_nulls",
    both_sql(
        SOURCE_VIEWS,
        "SELECT *, CASE WHEN null_rows = 0 THEN 'PASS' ELSE 'REVIEW' END AS status FROM ("
        + " UNION ALL ".join(null_sql(f"{{{SQL_NAME[t]}}}", t, cols) for t, cols in REQUIRED_COLUMNS.items())
        + ")",
    ),
)
def v13(spark, sf_dir):
    return both(lambda fin: I.required_nulls(fin, REQUIRED_COLUMNS), NO_LOOKUP)(spark, sf_dir)


def _pairs(spark, sf_dir, names):
    source = V.finance(spark, sf_dir)
    target = V.faulty(source)
    return [(name, source[name], target[name]) for name in names]


@query(
    "v14_null_distribution",
    with_views(
        f"{SOURCE_VIEWS} {COPY_VIEWS}",
        "SELECT s.table_name, s.column_name, s.null_rows AS source_nulls, s.total_rows AS source_rows, t.null_rows AS target_nulls, t.total_rows AS target_rows, "
        "CASE WHEN s.null_rows = t.null_rows THEN 'PASS' ELSE 'REVIEW' END AS status FROM ("
        + " UNION ALL ".join(null_sql(SQL_NAME[t], t, TABLES[t].names) for t in TABLES)
        + ") s JOIN ("
        + " UNION ALL ".join(null_sql("t_" + SQL_NAME[t], t, TABLES[t].names) for t in TABLES)
        + ") t USING (table_name, column_name)",
    ),
)
def v14(spark, sf_dir):
    pairs = _pairs(spark, sf_dir, list(TABLES))
    return union_all([ST.null_distribution(s, t, name) for name, s, t in pairs])


@query(
    "v15_date_coverage",
    both_sql(
        "gl",
        """SELECT earliest_date, latest_date, fiscal_years, CAST(days_span AS INTEGER) AS days_span,
        CASE WHEN year(earliest_date) >= 1995 AND year(latest_date) <= 2001 AND days_span > 1000 THEN 'PASS' ELSE 'REVIEW' END AS status FROM (
        SELECT MIN(transaction_date) AS earliest_date, MAX(transaction_date) AS latest_date, COUNT(DISTINCT fiscal_year) AS fiscal_years,
        date_diff('day', MIN(transaction_date), MAX(transaction_date)) AS days_span FROM {gl})""",
    ),
)
def v15(spark, sf_dir):
    return both(lambda fin: B.date_coverage(fin["gl_transactions"], 1995, 2001), NO_LOOKUP)(spark, sf_dir)


def _range_sql(table: str, column: str) -> str:
    v = SQL_NAME[table]
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, (SELECT MIN({column}) FROM {v}) AS source_min, (SELECT MAX({column}) FROM {v}) AS source_max,
        (SELECT MIN({column}) FROM t_{v}) AS target_min, (SELECT MAX({column}) FROM t_{v}) AS target_max"""


@query(
    "v16_date_ranges",
    with_views(
        "inv t_inv gl t_gl",
        "SELECT *, CASE WHEN source_min IS NOT DISTINCT FROM target_min AND source_max IS NOT DISTINCT FROM target_max THEN 'PASS' ELSE 'REVIEW' END AS status FROM ("
        + " UNION ALL ".join(
            _range_sql(t, c)
            for t, c in (
                ("invoices", "invoice_date"),
                ("invoices", "due_date"),
                ("invoices", "payment_date"),
                ("gl_transactions", "transaction_date"),
                ("gl_transactions", "posting_date"),
            )
        )
        + ")",
    ),
)
def v16(spark, sf_dir):
    source = V.finance(spark, sf_dir, NO_LOOKUP)
    target = V.faulty(source)
    return union_all([ST.date_ranges(source[n], target[n], n) for n in ("invoices", "gl_transactions")])


@query(
    "v17_duplicate_keys",
    both_sql(
        SOURCE_VIEWS,
        "SELECT *, CASE WHEN duplicate_keys = 0 THEN 'PASS' ELSE 'REVIEW' END AS status FROM ("
        + " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, COUNT(*) AS duplicate_keys, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS surplus_rows FROM "
            f"(SELECT COUNT(*) AS n FROM {{{SQL_NAME[t]}}} GROUP BY {', '.join(keys)} HAVING COUNT(*) > 1)"
            for t, keys in PRIMARY_KEYS.items()
        )
        + ")",
    ),
)
def v17(spark, sf_dir):
    def check(fin):
        return union_all([I.duplicate_summary(name, fin[name], keys) for name, keys in PRIMARY_KEYS.items()])

    return both(check, NO_LOOKUP)(spark, sf_dir)


@query(
    "v18_budget_variance",
    both_sql(
        "bud",
        f"""SELECT budget_id, budget_amount, actual_amount, variance_amount, variance_percent, CAST(actual_amount - budget_amount AS DECIMAL(18,2)) AS calculated_variance,
        CASE WHEN budget_amount > 0 THEN {PERCENT} ELSE 0 END AS calculated_percent,
        CASE WHEN abs(variance_amount - (actual_amount - budget_amount)) < 0.01 THEN 'PASS' ELSE 'FAIL' END AS status FROM {{bud}}""",
    ),
)
def v18(spark, sf_dir):
    return both(lambda fin: B.variance_check(fin["budget_actual"]))(spark, sf_dir)


@query(
    "v19_invoice_status_rules",
    both_sql(
        "inv",
        f"""SELECT status, COUNT(*) AS invoice_count, {exact_ratio(cents('SUM(invoice_amount)'), 'COUNT(invoice_amount)')} AS avg_invoice,
        {exact_ratio(cents('SUM(paid_amount)'), 'COUNT(paid_amount)')} AS avg_paid,
        {exact_ratio(cents('SUM(outstanding_amount)'), 'COUNT(outstanding_amount)')} AS avg_outstanding,
        COUNT(*) FILTER (status = 'Paid' AND outstanding_amount > 0) AS invalid_paid,
        COUNT(*) FILTER (status = 'Open' AND paid_amount > 0) AS invalid_open FROM {{inv}} GROUP BY 1""",
    ),
)
def v19(spark, sf_dir):
    return both(lambda fin: B.status_rules(fin["invoices"]))(spark, sf_dir)


PERCENTAGE = exact_ratio("COUNT(*) * 10000", "SUM(COUNT(*)) OVER ()")


@query(
    "v20_status_distribution",
    both_sql(
        "inv",
        f"""SELECT status, COUNT(*) AS invoice_count, {scaled('SUM(invoice_amount)', B.MILLION)} AS total_amount_m,
        {scaled('SUM(outstanding_amount)', B.MILLION)} AS outstanding_m,
        {exact_ratio(cents('SUM(invoice_amount)'), 'COUNT(invoice_amount)')} AS avg_invoice,
        CAST({PERCENTAGE} AS DECIMAL(5,2)) AS percentage FROM {{inv}} GROUP BY 1""",
    ),
)
def v20(spark, sf_dir):
    return both(lambda fin: B.status_distribution(fin["invoices"]))(spark, sf_dir)


@query(
    "v21_variance_distribution",
    both_sql(
        "bud",
        f"""SELECT variance_category, COUNT(*) AS record_count, {exact_ratio(cents('SUM(variance_percent)'), 'COUNT(*)')} AS avg_variance_pct,
        CAST({PERCENTAGE} AS DECIMAL(5,2)) AS percentage FROM (SELECT {BANDS} AS variance_category, variance_percent FROM {{bud}}) GROUP BY 1""",
    ),
)
def v21(spark, sf_dir):
    return both(lambda fin: B.variance_distribution(fin["budget_actual"]))(spark, sf_dir)


def _share_sql(n: str) -> str:
    return f"CAST({exact_ratio(f'{n} * 10000', f'SUM({n}) OVER ()', 4)} AS DECIMAL(9,4))"


@query(
    "v22_distribution_gap",
    with_views(
        "inv t_inv",
        f"""SELECT *, CASE WHEN gap < 1 THEN 'PASS' ELSE 'REVIEW' END AS status FROM (SELECT *, CAST(abs(source_share - target_share) AS DECIMAL(9,4)) AS gap FROM (
        SELECT status AS category, source_count, target_count, {_share_sql('source_count')} AS source_share, {_share_sql('target_count')} AS target_share
        FROM (SELECT status, COUNT(*) AS source_count FROM inv GROUP BY 1) FULL JOIN (SELECT status, COUNT(*) AS target_count FROM t_inv GROUP BY 1) USING (status)))""",
    ),
)
def v22(spark, sf_dir):
    inv = V.invoices(spark, sf_dir)
    renamed = inv.withColumnRenamed("status", "category"), V.faulty_invoices(inv).withColumnRenamed("status", "category")
    return ST.distribution_gap(*renamed, "category")


@query(
    "v23_outliers",
    with_views(
        "metering",
        """, s AS (SELECT COUNT(*) AS n, CAST(SUM(credits_used) AS DOUBLE) AS s, CAST(SUM(CAST(credits_used * credits_used AS DECIMAL(34,4))) AS DOUBLE) AS q FROM metering),
        b AS (SELECT s / n AS mean, sqrt((q - s * (s / n)) / (n - 1)) AS sd FROM s)
        SELECT warehouse_name, start_time, credits_used FROM metering, b
        WHERE CAST(credits_used AS DOUBLE) > mean + 3 * sd OR CAST(credits_used AS DOUBLE) < mean - 3 * sd""",
    ),
)
def v23(spark, sf_dir):
    return ST.outliers(V.metering(spark, sf_dir), "credits_used", 3.0)


@query(
    "v24_numeric_precision",
    with_views(
        f"{SOURCE_VIEWS} {COPY_VIEWS}",
        "SELECT *, CASE WHEN source_scale = target_scale AND source_sum = target_sum THEN 'PASS' ELSE 'REVIEW' END AS status FROM ("
        + " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, {f.dataType.scale} AS source_scale, CAST((SELECT SUM({f.name}) FROM {SQL_NAME[t]}) AS DECIMAL(38,6)) AS source_sum, "
            f"{f.dataType.scale} AS target_scale, CAST((SELECT SUM({f.name}) FROM t_{SQL_NAME[t]}) AS DECIMAL(38,6)) AS target_sum"
            for t, f in DECIMALS
        )
        + ")",
    ),
)
def v24(spark, sf_dir):
    pairs = _pairs(spark, sf_dir, sorted({t for t, _ in DECIMALS}))
    return union_all([ST.numeric_precision(s, t).select(F.lit(name).alias("table_name"), "*") for name, s, t in pairs])


@query(
    "v26_sync_latency",
    with_views(
        "sync_log",
        """SELECT table_name, COUNT(*) AS runs, MAX(latency_ms) AS max_latency_ms, quantile_disc(latency_ms, 0.95) AS p95_latency_ms,
        COUNT(*) FILTER (latency_ms > 60000) AS over_limit, CASE WHEN MAX(latency_ms) <= 60000 THEN 'PASS' ELSE 'REVIEW' END AS status
        FROM sync_log GROUP BY 1""",
    ),
)
def v26(spark, sf_dir):
    return monitoring.sync_latency(V.sync_log(spark, sf_dir), limit_ms=60_000)


@query(
    "v27_count_variance",
    with_views(
        f"{SOURCE_VIEWS} {COPY_VIEWS}",
        f"""SELECT table_name, row_count, expected_count, {exact_ratio('abs(row_count - expected_count) * 100', 'expected_count', 6)} AS variance,
        'High' AS severity FROM ({COUNT_PAIRS}) WHERE abs(row_count - expected_count) > 0.01 * expected_count""",
    ),
)
def v27(spark, sf_dir):
    return STR.count_variance_alerts(*_counted(spark, sf_dir), tolerance=0.01)


def _measure_sql() -> list[str]:
    """One SELECT per measure: id, category, table, metric, expected, actual, rule, passing, minor."""
    out = []

    def add(check, category, table, metric, expr, rule="equal", passing=1, minor=0):
        v = SQL_NAME[table]
        expected = f"(SELECT {expr} FROM {v})" if rule == "equal" else "0"
        out.append(
            f"SELECT '{check}' AS check_id, '{category}' AS category, '{table}' AS entity, '{metric}' AS metric, CAST({expected} AS DECIMAL(38,6)) AS expected, "
            f"CAST((SELECT {expr} FROM t_{v}) AS DECIMAL(38,6)) AS actual, '{rule}' AS rule, {passing} AS passing, {minor} AS minor"
        )

    for table, schema in TABLES.items():
        add("V-01", "structural", table, "row_count", "COUNT(*)", minor=STR.COUNT_TOLERANCE[table])
        for c in REQUIRED_COLUMNS[table]:
            add("V-13", "integrity", table, f"required_nulls:{c}", f"COUNT(*) - COUNT({c})", "below")
        for f in schema.fields:
            add("V-14", "statistical", table, f"nulls:{f.name}", f"COUNT(*) - COUNT({f.name})")
            if f.dataType.typeName() == "decimal":
                add("V-24", "statistical", table, f"sum:{f.name}", f"SUM({f.name})")
            if f.dataType.typeName() == "date":
                for end, fn in (("first", "MIN"), ("last", "MAX")):
                    add("V-16", "statistical", table, f"{end}_day:{f.name}", f"date_diff('day', DATE '1970-01-01', {fn}({f.name}))")
    add("V-05", "business", "gl_transactions", "debits_minus_credits", "abs(SUM(debit_amount) - SUM(credit_amount))", "below", 100, 10000)
    add("V-18", "business", "budget_actual", "wrong_variance", "COUNT(*) FILTER (abs(variance_amount - (actual_amount - budget_amount)) >= 0.01)", "below")
    add("V-19", "business", "invoices", "paid_but_owing", "COUNT(*) FILTER (status = 'Paid' AND outstanding_amount > 0)", "below")
    add("V-19", "business", "invoices", "open_but_paid", "COUNT(*) FILTER (status = 'Open' AND paid_amount > 0)", "below")
    return out


#: Schema faults of the suite's copy: a column more, and one of another type.
DRIFTED = {"cost_centers": 1, "vendors": 1}


def _suite_body() -> str:
    rows = _measure_sql()
    judged = f"""SELECT check_id, category, entity, metric, expected, actual, CASE
        WHEN rule = 'equal' AND actual IS NOT DISTINCT FROM expected THEN 'PASS' WHEN rule = 'equal' AND abs(actual - expected) < minor THEN 'PASS_MINOR'
        WHEN rule = 'equal' THEN 'REVIEW' WHEN actual < passing THEN 'PASS' WHEN actual < minor THEN 'PASS_MINOR' ELSE 'REVIEW' END AS status,
        CAST(NULL AS VARCHAR) AS detail FROM ({' UNION ALL '.join(rows)})"""
    copy = {v: f"t_{v}" for v in SQL_NAME.values()}
    orphans = " UNION ALL ".join(orphan_sql(fk.name, SQL_NAME[fk.child], fk.column, SQL_NAME[fk.parent]).format(**copy) for fk in FOREIGN_KEYS)
    references = f"""SELECT 'V-11', 'integrity', reference, 'orphan_rows', CAST(0 AS DECIMAL(38,6)), CAST(orphan_rows AS DECIMAL(38,6)),
        {ladder('orphan_rows', '1', '100')}, CAST(CAST(COALESCE(orphan_keys, 0) AS BIGINT) AS VARCHAR) || ' keys' FROM ({orphans})"""
    duplicates = " UNION ALL ".join(
        f"SELECT 'V-17', 'integrity', '{t}', 'duplicate_keys', CAST(0 AS DECIMAL(38,6)), CAST(COUNT(*) AS DECIMAL(38,6)), "
        f"CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'REVIEW' END, NULL FROM (SELECT 1 FROM t_{SQL_NAME[t]} GROUP BY {', '.join(keys)} HAVING COUNT(*) > 1)"
        for t, keys in PRIMARY_KEYS.items()
    )
    schema = " UNION ALL ".join(
        f"SELECT 'V-04', 'schema', '{t}', 'drifted_columns', CAST(0 AS DECIMAL(38,6)), CAST({DRIFTED.get(t, 0)} AS DECIMAL(38,6)), '{'REVIEW' if t in DRIFTED else 'PASS'}', NULL" for t in TABLES
    )
    gaps = " UNION ALL ".join(
        f"""SELECT 'V-22', 'statistical', '{t}', 'largest_share_gap:{c}', CAST(0 AS DECIMAL(38,6)), CAST(MAX(gap) AS DECIMAL(38,6)),
        CASE WHEN MAX(gap) < 1 THEN 'PASS' ELSE 'REVIEW' END, NULL FROM (SELECT abs({_share_sql('a')} - {_share_sql('b')}) AS gap FROM
        (SELECT {c}, COUNT(*) AS a FROM {SQL_NAME[t]} GROUP BY 1) FULL JOIN (SELECT {c}, COUNT(*) AS b FROM t_{SQL_NAME[t]} GROUP BY 1) USING ({c}))"""
        for t, c in (("invoices", "status"), ("vendors", "payment_terms"))
    )
    return " UNION ALL ".join([judged, references, duplicates, schema, gaps])


def _suite_sql() -> str:
    return with_views(f"{SOURCE_VIEWS} {COPY_VIEWS}", _suite_body())


def _faulty(source):
    """The faulty copy, with a changed schema as well."""
    target = V.faulty(source)
    drifted = {
        "cost_centers": target["cost_centers"].withColumn("notes", F.lit("added")),
        "vendors": target["vendors"].withColumn("vendor_id", F.col("vendor_id").cast("int")),
    }
    return {**target, **drifted}


def _suite(spark, sf_dir):
    source = V.finance(spark, sf_dir)
    return suite.run_suite(spark, source, _faulty(source))


@query("v28_suite", _suite_sql())
def v28(spark, sf_dir):
    return _suite(spark, sf_dir)


@query(
    "v28_suite_summary",
    f"""SELECT category, COUNT(*) AS checks, COUNT(*) FILTER (status <> 'REVIEW') AS passed, COUNT(*) FILTER (status = 'REVIEW') AS failed,
    CAST({exact_ratio("COUNT(*) FILTER (status <> 'REVIEW') * 10000", 'COUNT(*)')} AS DECIMAL(5,2)) AS pass_rate FROM ({_suite_sql()}) GROUP BY 1""",
)
def v28_summary(spark, sf_dir):
    return suite.summary(_suite(spark, sf_dir))


@query(
    "v28_logged_suite",
    with_views(
        f"{SOURCE_VIEWS} {COPY_VIEWS}",
        f""", r AS (SELECT check_id, bool_or(status = 'REVIEW') AS failed FROM ({_suite_body()}) GROUP BY 1),
        o AS (SELECT 'check_failed' AS metric, check_id AS entity, TIMESTAMP '2024-05-01 06:00:00' AS ran_at, '1' AS run_id, FALSE AS failed FROM r
        UNION ALL SELECT 'check_failed', check_id, TIMESTAMP '2024-05-02 06:00:00', '2', failed FROM r), {SPANS}""",
    ),
)
def v28_logged(spark, sf_dir):
    """The suite on the faulty copy, logged a day after a run without a failure: the alerts that its log raises."""
    source = V.finance(spark, sf_dir)
    log = work_dir(spark, "suite-log")
    found = suite.run_logged(spark, source, _faulty(source), log, "2", dt.datetime(2024, 5, 2, 6))
    before = found.withColumns({"run_id": F.lit("1"), "run_ts": F.lit("2024-05-01 06:00:00").cast("timestamp_ntz"), "status": F.lit("PASS")})
    exports.append_log(before, log, "run_ts")
    return monitoring.alert_states(spark, monitoring.check_outcomes(spark.read.parquet(log)))


def _drill_sql() -> str:
    parts = []

    def add(check, table, key, body):
        parts.append(f"SELECT '{check}' AS check_name, '{table}' AS entity, COALESCE(CAST({key} AS VARCHAR), 'NULL') AS record {body}")

    for fk in FOREIGN_KEYS:
        add(f"V-11 {fk.name}", fk.child, f"c.{PRIMARY_KEYS[fk.child][0]}",
            f"FROM t_{SQL_NAME[fk.child]} c LEFT JOIN t_{SQL_NAME[fk.parent]} p ON c.{fk.column} = p.{fk.column} WHERE p.{fk.column} IS NULL")
    for t, (key,) in PRIMARY_KEYS.items():
        add(f"V-17 {t}", t, key, f"FROM t_{SQL_NAME[t]} GROUP BY {key} HAVING COUNT(*) > 1")
    nulls = " OR ".join(f"{c} IS NULL" for c in REQUIRED_COLUMNS["gl_transactions"])
    add("V-13 gl_transactions", "gl_transactions", "transaction_id", f"FROM t_gl WHERE {nulls}")
    add("V-18 budget_actual", "budget_actual", "budget_id", "FROM t_bud WHERE abs(variance_amount - (actual_amount - budget_amount)) >= 0.01")
    add("V-19 paid_but_owing", "invoices", "invoice_id", "FROM t_inv WHERE status = 'Paid' AND outstanding_amount > 0")
    add("V-19 open_but_paid", "invoices", "invoice_id", "FROM t_inv WHERE status = 'Open' AND paid_amount > 0")
    return with_views(COPY_VIEWS, " UNION ALL ".join(parts))


@query("v29_drill_down", _drill_sql())
def v29(spark, sf_dir):
    return suite.drill_down(V.faulty(V.finance(spark, sf_dir)))
