"""The finance tables, grants and logs as views over the driver's star-schema and event tables.

Every view is a projection (plus a lookup join where a column needs one) over whole tables. Keys
of dimension tables are unique, so lookups are left joins that neither lose nor repeat rows, and a
lookup is skipped when its column is not asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trueledger.functions import money, safe_percent
from trueledger.operators.grants import ROLE_MAPPING, role_mapping

DATABASE = "LEDGER_TEST"


_SCHEMAS: dict[str, T.StructType] = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is read from a footer once per path, not once per view."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _center(nation: Column) -> Column:
    return F.concat(F.lit("CC"), (nation + 1000).cast("string"))


def chart_of_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("account_number"),
        F.col("p_name").alias("account_name"),
        F.col("p_type").alias("account_type"),
    )


def cost_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _read(spark, sf_dir, "nation"), _read(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        _center(F.col("n_nationkey")).alias("cost_center"),
        F.col("n_name").alias("cost_center_name"),
        F.col("r_name").alias("business_unit"),
    )


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = F.element_at(
        F.array(F.lit("NET30"), F.lit("NET45"), F.lit("NET60")), (F.col("c_nationkey") % 3 + 1).cast("int")
    )
    return _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("vendor_id"),
        F.col("c_name").alias("vendor_name"),
        F.col("c_mktsegment").alias("vendor_type"),
        terms.alias("payment_terms"),
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = (
        F.when(key % 20 == 0, "Cancelled")
        .when(F.col("o_orderstatus") == "F", "Paid")
        .when(F.col("o_orderstatus") == "O", "Open")
        .when(F.col("o_orderstatus") == "P", "Overdue")
    )
    base = _read(spark, sf_dir, "orders").select(
        key.alias("invoice_id"),
        F.concat(F.lit("INV-"), key.cast("string")).alias("invoice_number"),
        F.col("o_custkey").alias("vendor_id"),
        F.col("o_orderdate").cast("date").alias("invoice_date"),
        money(F.col("o_totalprice")).alias("invoice_amount"),
        status.alias("status"),
        _center(key % 25).alias("cost_center"),
        (key % 500 + 1000).cast("string").alias("account_number"),
    )
    zero = F.lit(0).cast("decimal(18,2)")
    settled = F.when(F.col("status") == "Paid", F.col("invoice_amount")).otherwise(zero)
    owed = F.when(F.col("status").isin("Open", "Overdue"), F.col("invoice_amount")).otherwise(zero)
    paid_on = F.when(F.col("status") == "Paid", F.date_add("invoice_date", (F.col("invoice_id") % 60).cast("int")))
    return base.select(
        "invoice_id",
        "invoice_number",
        "vendor_id",
        "invoice_date",
        F.date_add("invoice_date", 30).alias("due_date"),
        paid_on.alias("payment_date"),
        "invoice_amount",
        settled.alias("paid_amount"),
        owed.alias("outstanding_amount"),
        "status",
        "cost_center",
        "account_number",
    )


def gl_transactions(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The ledger; ``columns`` prunes the view, and with it the supplier lookup."""
    day = F.col("l_shipdate").cast("date")
    price = money(F.col("l_extendedprice"))
    zero = F.lit(0).cast("decimal(18,2)")
    source = (
        F.when(F.col("l_returnflag") == "A", "AP").when(F.col("l_returnflag") == "R", "AR").otherwise("GL")
    )
    view = {
        "transaction_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "transaction_date": day,
        "posting_date": F.date_add(day, F.col("l_linenumber")),
        "fiscal_year": F.year(day),
        "fiscal_period": F.month(day),
        "account_number": F.col("l_partkey").cast("string"),
        "account_name": F.concat(F.lit("Account "), F.col("l_partkey").cast("string")),
        "cost_center": None,
        "department": F.concat(F.lit("D"), F.col("l_linenumber").cast("string")),
        "debit_amount": F.when(F.col("l_linestatus") == "F", price).otherwise(zero),
        "credit_amount": F.when(F.col("l_linestatus") == "O", price).otherwise(zero),
        "currency_code": F.lit("USD"),
        "description": F.concat(F.lit("Line "), F.col("l_linenumber").cast("string"), F.lit(" of "), F.col("l_orderkey").cast("string")),
        "source_system": source,
        "created_by": F.lit("loader"),
        "created_timestamp": F.col("l_shipdate"),
    }
    columns = columns or list(view)
    lines = _read(spark, sf_dir, "lineitem")
    if "cost_center" in columns:
        supplier = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        lines = lines.join(supplier, lines.l_suppkey == supplier.s_suppkey, "left")
        view["cost_center"] = _center(F.col("s_nationkey"))
    return lines.select(*[view[name].alias(name) for name in columns])


def budget_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budget and actual per center and month, summed map-side right after the supplier lookup."""
    day = F.col("l_shipdate").cast("date")
    supplier = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = _read(spark, sf_dir, "lineitem")
    by_center = (
        lines.join(supplier, lines.l_suppkey == supplier.s_suppkey)
        .groupBy("s_nationkey", F.year(day).alias("fiscal_year"), F.month(day).alias("fiscal_period"))
        .agg(
            money(F.sum(money(F.col("l_quantity"))) * 2000).alias("budget_amount"),
            money(F.sum(money(F.col("l_extendedprice")))).alias("actual_amount"),
        )
    )
    variance = money(F.col("actual_amount") - F.col("budget_amount"))
    return by_center.select(
        (F.col("fiscal_year").cast("bigint") * 100000 + F.col("fiscal_period") * 1000 + F.col("s_nationkey")).alias("budget_id"),
        _center(F.col("s_nationkey")).alias("cost_center"),
        "fiscal_year",
        "fiscal_period",
        "budget_amount",
        "actual_amount",
        variance.alias("variance_amount"),
        safe_percent(variance, F.col("budget_amount")).alias("variance_percent"),
    )


# Ledger columns that need no lookup.
LEDGER_ONLY = [
    "transaction_id", "transaction_date", "posting_date", "fiscal_year", "fiscal_period", "account_number", "account_name",
    "department", "debit_amount", "credit_amount", "currency_code", "description", "source_system", "created_by", "created_timestamp",
]


def finance(spark: SparkSession, sf_dir: str, gl_columns: list[str] | None = None) -> dict[str, DataFrame]:
    """The six tables, lazily."""
    return {
        "chart_of_accounts": chart_of_accounts(spark, sf_dir),
        "cost_centers": cost_centers(spark, sf_dir),
        "vendors": vendors(spark, sf_dir),
        "budget_actual": budget_actual(spark, sf_dir),
        "invoices": invoices(spark, sf_dir),
        "gl_transactions": gl_transactions(spark, sf_dir, gl_columns),
    }


# A faulty copy, so that every check also meets data it must report. Each fault is the kind a real
# copy job leaves behind: a day lost, a day loaded twice, cents dropped, values nulled.


def faulty_vendors(df: DataFrame) -> DataFrame:
    return df.where(~((F.col("vendor_type") == "MACHINERY") & (F.col("payment_terms") == "NET60")))


def faulty_cost_centers(df: DataFrame) -> DataFrame:
    return df.where(F.col("business_unit") != "ASIA")


def faulty_chart_of_accounts(df: DataFrame) -> DataFrame:
    return df.where(~((F.col("account_type") == "PROMO") & F.col("account_name").startswith("red")))


def _on(column: str, day: str) -> Column:
    return F.col(column) == F.lit(day).cast("date")


def _copies(is_doubled: Column) -> Column:
    return F.explode(F.when(is_doubled, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))


def faulty_invoices(df: DataFrame) -> DataFrame:
    day = lambda d: _on("invoice_date", d)
    faults = {
        "invoice_amount": ("1999-09-09", F.round("invoice_amount", 0).cast("decimal(18,2)")),
        "payment_date": ("2000-01-05", F.lit(None).cast("date")),
        "outstanding_amount": ("1996-05-05", F.col("invoice_amount")),
        "paid_amount": ("1996-05-06", F.lit(1).cast("decimal(18,2)")),
    }
    cols = [F.when(day(faults[c][0]), faults[c][1]).otherwise(F.col(c)).alias(c) if c in faults else F.col(c) for c in df.columns]
    return (
        df.where(~day("1997-06-15"))
        .withColumn("_copy", _copies(day("1998-03-10")))
        .select(*cols)
    )


def faulty_gl_transactions(df: DataFrame) -> DataFrame:
    day = lambda d: _on("transaction_date", d)
    zero = F.lit(0).cast("decimal(18,2)")
    faults = {
        "account_number": F.when(~day("1998-02-02"), F.col("account_number")),
        "debit_amount": F.when(day("1998-02-04"), zero).when(~day("1998-02-03"), F.col("debit_amount")),
        "credit_amount": F.when(day("1998-02-04"), zero).otherwise(F.col("credit_amount")),
    }
    cols = [faults[c].alias(c) if c in faults else F.col(c) for c in df.columns]
    return (
        df.where(~day("1999-12-31"))
        .withColumn("_copy", _copies(day("1997-07-07")))
        .select(*cols)
    )


def faulty_budget_actual(df: DataFrame) -> DataFrame:
    wrong = (F.col("fiscal_year") == 1998) & (F.col("fiscal_period") == 3)
    unbudgeted = (F.col("fiscal_year") == 1998) & (F.col("fiscal_period") == 4)
    return df.select(
        "budget_id",
        "cost_center",
        "fiscal_year",
        "fiscal_period",
        F.when(unbudgeted, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("budget_amount")).alias("budget_amount"),
        "actual_amount",
        money(F.when(wrong, F.col("variance_amount") + 1).otherwise(F.col("variance_amount"))).alias("variance_amount"),
        "variance_percent",
    )


def faulty(fin: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The same six tables after a faulty copy."""
    return {
        "chart_of_accounts": faulty_chart_of_accounts(fin["chart_of_accounts"]),
        "cost_centers": faulty_cost_centers(fin["cost_centers"]),
        "vendors": faulty_vendors(fin["vendors"]),
        "budget_actual": faulty_budget_actual(fin["budget_actual"]),
        "invoices": faulty_invoices(fin["invoices"]),
        "gl_transactions": faulty_gl_transactions(fin["gl_transactions"]),
    }


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered change events per user account: ``op`` I/U/D, ``seq`` by time, ``tie`` by event id."""
    return change_columns(_read(spark, sf_dir, "events"))


def change_columns(events: DataFrame) -> DataFrame:
    op = (
        F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    )
    return events.select(
        F.col("user_id").alias("account_id"),
        op.alias("op"),
        F.col("ts").alias("seq"),
        F.col("event_id").alias("tie"),
        money(F.col("value")).alias("balance"),
        F.col("event_type").alias("last_event"),
    )


def role_name(user: Column) -> Column:
    """Five named roles; every other user id is a team's role."""
    return (
        F.when(user == 0, "FINANCE_ADMIN")
        .when(user == 1, "AP_MANAGER")
        .when(user == 2, "BUDGET_ANALYST")
        .when(user == 3, "FINANCE_ANALYST")
        .when(user == 4, "FINANCE_VIEWER")
        .otherwise(F.concat(F.lit("TEAM_"), user.cast("string")))
    )


def raw_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grant export with the eight positions of a grants listing, one row per event."""
    user, kind = F.col("user_id"), F.col("event_type")
    rank = user % 5
    privilege = (
        F.when(kind == "signup", "USAGE")
        .when((kind == "error") & (rank == 0), "DELETE")
        .when((kind == "purchase") & rank.isin(0, 1), "UPDATE")
        .when((kind == "click") & rank.isin(0, 1, 2), "INSERT")
        .otherwise("SELECT")
    )
    tables = F.array(*[F.lit(t) for t in TABLE_ORDER])
    pick = F.when(rank == 4, F.col("event_id") % 2).otherwise(F.col("event_id") % 6)
    granted_on = F.when(kind != "signup", "TABLE").when(F.col("event_id") % 2 == 0, "DATABASE").otherwise("WAREHOUSE")
    name = (
        F.when(granted_on == "TABLE", F.concat(F.lit(f"{DATABASE}.MAIN."), F.element_at(tables, (pick + 1).cast("int"))))
        .when(granted_on == "DATABASE", DATABASE)
        .otherwise("COMPUTE_WH")
    )
    return _read(spark, sf_dir, "events").select(
        F.col("ts").alias("created_on"),
        privilege.alias("privilege"),
        granted_on.alias("granted_on"),
        name.alias("name"),
        F.lit("ROLE").alias("granted_to"),
        role_name(user).alias("grantee_name"),
        F.lit("false").alias("grant_option"),
        F.when(F.col("value") >= 1, "SECURITYADMIN").alias("granted_by"),
    )


TABLE_ORDER = [
    "GL_TRANSACTIONS",
    "INVOICES",
    "BUDGET_ACTUAL",
    "VENDORS",
    "COST_CENTERS",
    "CHART_OF_ACCOUNTS",
]


def _email(user: Column) -> Column:
    return F.concat(F.lit("user"), user.cast("string"), F.lit("@company.com"))


def team_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping rows for team roles, one per customer; one segment has none on purpose.

    Ids 0 to 4 are the named roles, which have a fixed mapping of their own.
    """
    access = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Admin")
        .when(F.col("c_mktsegment") == "BUILDING", "Member")
        .when(F.col("c_mktsegment") == "FURNITURE", "Contributor")
        .when(F.col("c_mktsegment") == "MACHINERY", "Viewer")
    )
    return (
        _read(spark, sf_dir, "customer")
        .where("c_custkey > 4")
        .select(
            role_name(F.col("c_custkey")).alias("source_role"),
            access.alias("access_role"),
            _email(F.col("c_custkey")).alias("user_email"),
            F.concat(F.lit("Team of segment "), F.col("c_mktsegment")).alias("reasoning"),
        )
        .where(F.col("access_role").isNotNull())
    )


def roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roles to migrate: the five named ones (ids 0 to 4) and every other id's team role."""
    named = spark.createDataFrame([(row[0],) for row in ROLE_MAPPING], "role string")
    teams = _read(spark, sf_dir, "customer").where("c_custkey > 4").select(role_name(F.col("c_custkey")).alias("role"))
    return named.unionByName(teams)


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_mapping(spark).unionByName(team_mapping(spark, sf_dir))


def current_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who is a member of the workspace today, and with which access."""
    access = F.element_at(
        F.array(F.lit("Admin"), F.lit("Member"), F.lit("Contributor"), F.lit("Viewer")),
        (F.col("c_nationkey") % 4 + 1).cast("int"),
    )
    return (
        _read(spark, sf_dir, "customer")
        .where("c_acctbal > 0")
        .select(_email(F.col("c_custkey")).alias("user_email"), access.alias("access_role"))
    )


def email_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured addresses that replace the mapped one: teams whose account is overdrawn."""
    return (
        _read(spark, sf_dir, "customer")
        .where("c_acctbal < 0")
        .select(
            role_name(F.col("c_custkey")).alias("source_role"),
            F.concat(F.lit("owner"), F.col("c_custkey").cast("string"), F.lit("@company.com")).alias("user_email"),
        )
    )


def entitlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which cost center each user may see."""
    return _read(spark, sf_dir, "customer").select(
        _email(F.col("c_custkey")).alias("email"), _center(F.col("c_nationkey")).alias("cost_center")
    )


def sync_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sync run: when the source committed, when the copy had it, rows, error."""
    tables = F.array(*[F.lit(t) for t in TABLE_ORDER])
    centis = F.round(F.col("value") * 100).cast("bigint")
    return _read(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.element_at(tables, (F.col("event_id") % 6 + 1).cast("int")).alias("table_name"),
        F.col("ts").alias("sync_start"),
        F.timestamp_add("MILLISECOND", centis * 10, F.col("ts")).alias("sync_end"),
        centis.alias("rows_synced"),
        F.when(F.col("event_type") == "error", "sync failed").alias("error"),
    )


def check_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of every past check run."""
    category = F.element_at(
        F.array(*[F.lit(c) for c in ("structural", "schema", "integrity", "business", "statistical")]),
        (F.col("user_id") % 5 + 1).cast("int"),
    )
    return _read(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("ts").alias("run_ts"),
        category.alias("category"),
        F.concat(F.lit("check_"), (F.col("user_id") % 40).cast("string")).alias("check_id"),
        F.when(F.col("event_type") == "error", "REVIEW").otherwise("PASS").alias("status"),
    )


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select(
        F.concat(F.lit("user"), (F.col("user_id") % 10).cast("string")).alias("user_id"),
        F.col("ts").alias("started_at"),
        money(F.col("value")).alias("seconds"),
        F.col("event_type").alias("query"),
    )


def metering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select(
        F.concat(F.upper("event_type"), F.lit("_WH")).alias("warehouse_name"),
        F.col("ts").alias("start_time"),
        money(F.col("value")).alias("credits_used"),
    )
