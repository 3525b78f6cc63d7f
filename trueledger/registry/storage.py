"""Loading, versions, exports and metadata by name. What a job writes is read back and returned."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from trueledger.operators import grants as G
from trueledger.operators.structural import row_count_parity
from trueledger.registry import query
from trueledger.registry.checks import NO_LOOKUP, SOURCE_VIEWS, SQL_NAME
from trueledger.registry.ctes import with_views
from trueledger.schemas import FOREIGN_KEYS, INVOICES, PRIMARY_KEYS, TABLES
from trueledger.sources import exports, generate, snapshots, tables
from trueledger.sources import testviews as V
from trueledger.sources.tables import union_all
from trueledger.session import work_dir

COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {v}" for t, v in SQL_NAME.items())


def _loaded(spark, sf_dir, names=None, purpose="load"):
    fin = V.finance(spark, sf_dir)
    fin = {name: fin[name] for name in (names or fin)}
    root = work_dir(spark, purpose)
    return fin, root, snapshots.load(spark, fin, root)


@query("s01_table_scan", with_views("vendors", "SELECT * FROM vendors"))
def s01(spark, sf_dir):
    _, root, _ = _loaded(spark, sf_dir, ["vendors"], "scan")
    return tables.read_table(spark, root, "vendors")


GENERATED_FROM = {
    "chart_of_accounts": "part",
    "cost_centers": "supplier",
    "vendors": "customer",
    "budget_actual": "orders",
    "invoices": "orders",
    "gl_transactions": "lineitem",
}


@query(
    "s02_generate",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, COUNT(*) AS distinct_keys, CAST(0 AS BIGINT) AS broken_rows FROM {v}"
        for t, v in GENERATED_FROM.items()
    ),
)
def s02(spark, sf_dir):
    """As many generated rows as the test tables hold, checked for unique keys, valid references and rules."""
    rows = {t: spark.read.parquet(f"{sf_dir}/{v}.parquet").count() for t, v in GENERATED_FROM.items()}
    made = generate.generate(spark, rows)
    parts = []
    for name, df in made.items():
        (key,) = PRIMARY_KEYS[name]
        for fk in FOREIGN_KEYS:
            if fk.child == name:
                parent = made[fk.parent].select(F.col(fk.column).alias("_p"))
                df = df.join(parent, F.col(fk.column) == F.col("_p"), "left").withColumn(
                    f"_no_{fk.column}", F.col("_p").isNull()
                ).drop("_p")
        flags = [F.col(c) for c in df.columns if c.startswith("_no_")]
        if name == "invoices":
            flags.append(F.col("paid_amount") + F.col("outstanding_amount") > F.col("invoice_amount"))
        if name == "gl_transactions":
            flags.append((F.col("debit_amount") > 0) == (F.col("credit_amount") > 0))
        broken = F.lit(False)
        for flag in flags:
            broken = broken | flag
        parts.append(
            df.agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct(key).alias("distinct_keys"), F.count_if(broken).alias("broken_rows"))
            .select(F.lit(name).alias("table_name"), "row_count", "distinct_keys", "broken_rows")
        )
    return union_all(parts)


DRAWN = ("vendor_id", "cost_center", "account_number", "status", "invoice_date")


@query(
    "s03_generated_shares",
    with_views(
        "inv",
        " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, 2 * COUNT(*) AS row_count, CAST(0 AS BIGINT) AS broken_rows FROM inv GROUP BY 2" for c in DRAWN),
    ),
)
def s03(spark, sf_dir):
    """Twice as many generated invoices as there are given ones: every value has twice its given rows."""
    given = V.invoices(spark, sf_dir)
    made = generate.invoices_like(spark, given, 2 * given.count())
    broken = F.count_if((F.col("status") == "Paid") != F.col("payment_date").isNotNull())
    counts = [
        made.groupBy(F.col(c).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"), broken.alias("broken_rows"))
        .select(F.lit(c).alias("column_name"), "value", "row_count", "broken_rows")
        for c in DRAWN
    ]
    return union_all(counts)


@query("s04_load_tables", with_views(SOURCE_VIEWS, f"SELECT table_name, TRUE AS loaded, row_count FROM ({COUNTS})"))
def s04(spark, sf_dir):
    fin, root, report = _loaded(spark, sf_dir)
    return report.join(tables.row_counts(tables.read_tables(spark, root)), "table_name").select("table_name", "loaded", "row_count")


@query("s05_namespace", with_views("cc", "SELECT * FROM cc"))
def s05(spark, sf_dir):
    root = work_dir(spark, "namespace")
    tables.ensure_namespace(spark, "trueledger_check", root)
    snapshots.load_into({"cost_centers": V.cost_centers(spark, sf_dir)}, "trueledger_check", root)
    return spark.table("trueledger_check.cost_centers")


@query("s06_verify_load", with_views(SOURCE_VIEWS, f"SELECT table_name, row_count, row_count AS expected_count, TRUE AS valid FROM ({COUNTS})"))
def s06(spark, sf_dir):
    fin, root, _ = _loaded(spark, sf_dir)
    return snapshots.verify_load(spark, root, tables.row_counts(fin))


@query("s07_load_summary", with_views(SOURCE_VIEWS, f"SELECT COUNT(*) AS tables, CAST(SUM(row_count) AS BIGINT) AS total_rows FROM ({COUNTS})"))
def s07(spark, sf_dir):
    fin, root, _ = _loaded(spark, sf_dir)
    return snapshots.load_summary(spark, root, list(fin)).select("tables", "total_rows")


@query(
    "s08_snapshot_versions",
    with_views(
        "vendors inv t_inv",
        """SELECT 'vendors' AS table_name, 1 AS version, COUNT(*) AS row_count, 'month end' AS label FROM vendors
        UNION ALL SELECT 'invoices', 1, COUNT(*), 'month end' FROM inv UNION ALL SELECT 'invoices', 2, COUNT(*), NULL FROM t_inv""",
    ),
)
def s08(spark, sf_dir):
    root = work_dir(spark, "snapshot")
    inv = V.invoices(spark, sf_dir)
    snapshots.snapshot(spark, {"vendors": V.vendors(spark, sf_dir), "invoices": inv}, root, "month end")
    snapshots.snapshot(spark, {"invoices": V.faulty_invoices(inv)}, root)
    return snapshots.versions(spark, root)


@query("s09_grants_csv", with_views("raw_grants", "SELECT role, privilege, granted_on, name, granted_by FROM raw_grants"))
def s09(spark, sf_dir):
    path = work_dir(spark, "grants-csv")
    exports.export_csv(G.export_grants(V.raw_grants(spark, sf_dir)), path)
    return exports.read_csv(spark, path, G.GRANTS)


@query(
    "s10_mapping_csv",
    with_views(
        "roles raw_grants mapping",
        """SELECT source_role, access_role, user_email, COUNT(raw_grants.role) AS grant_count FROM mapping JOIN roles ON source_role = roles.role
        LEFT JOIN raw_grants ON raw_grants.role = source_role GROUP BY 1, 2, 3""",
    ),
)
def s10(spark, sf_dir):
    path = work_dir(spark, "mapping-csv")
    exports.export_csv(
        G.map_roles(V.roles(spark, sf_dir), G.export_grants(V.raw_grants(spark, sf_dir)), V.mapping(spark, sf_dir)), path
    )
    return exports.read_csv(spark, path, G.MAPPING).drop("reasoning")


@query(
    "s12_archive",
    with_views(
        "gl",
        """SELECT fiscal_year, fiscal_period, COUNT(*) AS row_count, CAST(SUM(debit_amount) AS DECIMAL(28,2)) AS total_debits
        FROM gl WHERE transaction_date < DATE '1999-01-01' GROUP BY 1, 2""",
    ),
)
def s12(spark, sf_dir):
    path = work_dir(spark, "archive")
    exports.archive(V.gl_transactions(spark, sf_dir, NO_LOOKUP), path, "transaction_date", dt.date(1999, 1, 1))
    return (
        spark.read.parquet(path)
        .groupBy("fiscal_year", "fiscal_period")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("debit_amount").cast("decimal(28,2)").alias("total_debits"))
    )


@query(
    "s13_tiers",
    with_views(
        "inv",
        """SELECT CASE WHEN invoice_date >= DATE '2000-01-01' THEN 'hot' WHEN invoice_date < DATE '1999-03-01' THEN 'archive' ELSE 'warm' END AS tier,
        COUNT(*) AS row_count, CAST(SUM(invoice_amount) AS DECIMAL(28,2)) AS total_amount FROM inv GROUP BY 1""",
    ),
)
def s13(spark, sf_dir):
    path = work_dir(spark, "tiers")
    exports.write_tiers(V.invoices(spark, sf_dir), path, "invoice_date", dt.date(2001, 3, 1))
    return (
        spark.read.parquet(path)
        .groupBy("tier")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("invoice_amount").cast("decimal(28,2)").alias("total_amount"))
    )


@query("s14_csv_fallback", with_views("inv", "SELECT * FROM inv"))
def s14(spark, sf_dir):
    path = work_dir(spark, "csv")
    exports.export_csv(V.invoices(spark, sf_dir), path)
    return exports.read_csv(spark, path, INVOICES)


@query(
    "s15_run_log",
    with_views(
        "check_log",
        """SELECT CAST(run_ts AS DATE) AS run_date, COUNT(*) AS runs, COUNT(*) FILTER (status <> 'PASS') AS failures FROM check_log
        WHERE CAST(run_ts AS DATE) >= DATE '2024-01-17' GROUP BY 1""",
    ),
)
def s15(spark, sf_dir):
    path = work_dir(spark, "run-log")
    exports.append_log(V.check_log(spark, sf_dir), path, "run_ts")
    exports.expire_log(spark, path, dt.date(2024, 4, 16))
    kept = spark.read.parquet(path)  # nothing older is left
    return kept.groupBy("run_date").agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") != "PASS").alias("failures"))


@query(
    "s16_table_overview",
    with_views(SOURCE_VIEWS, f"SELECT table_name, row_count, CAST(row_number() OVER (ORDER BY row_count DESC, table_name) AS INTEGER) AS place, TRUE AS has_size, TRUE AS has_time FROM ({COUNTS})"),
)
def s16(spark, sf_dir):
    _, root, _ = _loaded(spark, sf_dir)
    found = tables.table_overview(spark, {name: f"{root}/{name}" for name in TABLES})
    # Bytes and times differ from run to run; that there are some, and the order, can be compared.
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    return found.select("table_name", "row_count", place.alias("place"), (F.col("size_mb") >= 0).alias("has_size"), F.col("created").isNotNull().alias("has_time"))


@query(
    "s17_column_metadata",
    with_views(
        SOURCE_VIEWS,
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, {i} AS ordinal_position, '{f.dataType.simpleString()}' AS data_type, "
            f"COUNT({f.name}) AS filled_values, "
            + (f"CAST(MAX(length({f.name})) AS INTEGER)" if f.dataType.simpleString() == "string" else "CAST(NULL AS INTEGER)")
            + f" AS longest_text FROM {SQL_NAME[t]}"
            for t, schema in TABLES.items()
            for i, f in enumerate(schema.fields, 1)
        ),
    ),
)
def s17(spark, sf_dir):
    # Nullability of views and declared text lengths are constants here; the rest is compared.
    return tables.observed_columns(spark, V.finance(spark, sf_dir)).drop("is_nullable", "max_length")


@query(
    "s17_declared_columns",
    with_views(
        "vendors",
        """SELECT 'declared' AS table_name, 'vendor_id' AS column_name, 1 AS ordinal_position, 'bigint' AS data_type, TRUE AS is_nullable, CAST(NULL AS INTEGER) AS max_length,
          COUNT(vendor_id) AS filled_values, CAST(NULL AS INTEGER) AS longest_text FROM vendors
        UNION ALL SELECT 'declared', 'vendor_name', 2, 'string', TRUE, 50, COUNT(vendor_name), CAST(MAX(length(vendor_name)) AS INTEGER) FROM vendors
        UNION ALL SELECT 'declared', 'payment_terms', 3, 'string', TRUE, 10, COUNT(payment_terms), CAST(MAX(length(payment_terms)) AS INTEGER) FROM vendors
        UNION ALL SELECT 'counted', 'payment_terms', 1, 'string', FALSE, NULL, COUNT(DISTINCT payment_terms), CAST(MAX(length(payment_terms)) AS INTEGER) FROM vendors
        UNION ALL SELECT 'counted', 'vendor_count', 2, 'bigint', FALSE, NULL, COUNT(DISTINCT payment_terms), NULL FROM vendors""",
    ),
)
def s17_declared(spark, sf_dir):
    """Declared lengths of a catalog table, and a column that cannot be NULL."""
    vendors = V.vendors(spark, sf_dir)
    columns = {"vendor_id": "bigint", "vendor_name": "varchar(50)", "payment_terms": "varchar(10)"}
    declared = tables.declare_table(spark, "trueledger_check", "declared_vendors", columns, work_dir(spark, "declared"))
    vendors.select(*columns).write.insertInto("trueledger_check.declared_vendors")
    declared = spark.table("trueledger_check.declared_vendors")
    counted = vendors.groupBy("payment_terms").agg(F.count(F.lit(1)).alias("vendor_count"))
    return tables.observed_columns(spark, {"declared": declared, "counted": counted})


@query(
    "s18_storage_metadata",
    with_views(
        SOURCE_VIEWS,
        f"SELECT table_name, row_count, TRUE AS has_bytes, TRUE AS has_files, CAST(NULL AS INTEGER) AS retention_days, CAST(NULL AS VARCHAR) AS clustering_key FROM ({COUNTS})",
    ),
)
def s18(spark, sf_dir):
    _, root, _ = _loaded(spark, sf_dir)
    found = tables.storage_metadata(spark, {name: f"{root}/{name}" for name in TABLES})
    return found.select("table_name", "row_count", (F.col("bytes") > 0).alias("has_bytes"), (F.col("files") > 0).alias("has_files"), "retention_days", "clustering_key")


@query(
    "s19_preview",
    with_views("gl", "SELECT transaction_id, transaction_date, account_number, debit_amount, credit_amount FROM gl ORDER BY transaction_date, transaction_id, account_number, debit_amount, credit_amount LIMIT 10"),
)
def s19(spark, sf_dir):
    shown = ["transaction_id", "transaction_date", "account_number", "debit_amount", "credit_amount"]
    gl = V.gl_transactions(spark, sf_dir, [*V.LEDGER_ONLY]).select(*shown)
    return tables.preview(gl, 10, ["transaction_date", "transaction_id", "account_number", "debit_amount", "credit_amount"])


@query(
    "f01_snapshot_verified",
    with_views(
        SOURCE_VIEWS,
        f"SELECT table_name, row_count, row_count AS expected_count, 'PASS' AS status FROM ({COUNTS})",
    ),
)
def f01(spark, sf_dir):
    fin = V.finance(spark, sf_dir)
    root = work_dir(spark, "initial")
    snapshots.snapshot(spark, fin, root)
    copies = {name: snapshots.read_version(spark, root, name) for name in fin}
    return row_count_parity(copies, tables.row_counts(fin))
