"""Finance questions over the six tables.

Where a report needs a fact per dimension row (per vendor, per center), the fact is summed by the
join key first. That sum is combined map-side, so a key holding a third of the fact reaches the
join as one row, and it leaves the data partitioned the way the join wants it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trueledger.functions import as_of_date, money, ratio, safe_percent
from trueledger.functions.finance import scaled

THOUSAND, MILLION = 1_000, 1_000_000


def _fiscal_from(gl: DataFrame, first_year: int) -> DataFrame:
    """Years from ``first_year`` on. The date bound says the same in a form the scan can use."""
    return gl.where((F.col("fiscal_year") >= first_year) & (F.col("transaction_date") >= F.lit(dt.date(first_year, 1, 1))))


def _monthly_by_type(gl: DataFrame, accounts: DataFrame) -> DataFrame:
    """Sums per month and account type.

    The ledger meets the accounts first: a chart that fits is broadcast and only the few report
    groups are shuffled. A larger one is sort-merged, and AQE splits the partition of an account
    that holds too much of the ledger. Summing per account and month beforehand would shuffle the
    ledger a second time, since the join needs it by account alone.
    """
    return (
        gl.join(accounts.select("account_number", "account_type"), "account_number")
        .groupBy("fiscal_year", "fiscal_period", "account_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("debit_amount").alias("debit"), F.sum("credit_amount").alias("credit"))
    )


def monthly_pnl(gl: DataFrame, accounts: DataFrame, first_year: int) -> DataFrame:
    """Transactions and net amount (millions) per year, period and account type."""
    return (
        _monthly_by_type(_fiscal_from(gl, first_year), accounts)
        .select(
            "fiscal_year",
            "fiscal_period",
            "account_type",
            F.col("n").alias("transaction_count"),
            scaled(F.col("debit") - F.col("credit"), MILLION).alias("net_amount_m"),
        )
        .orderBy(F.desc("fiscal_year"), F.desc("fiscal_period"), "account_type")
    )


def pnl_by_grain(gl: DataFrame, accounts: DataFrame) -> DataFrame:
    """The same statement per month, quarter and year, from one pass over the ledger."""
    monthly = _monthly_by_type(gl, accounts)
    quarter = F.ceil(F.col("fiscal_period") / 3).cast("int")
    grains = F.array(
        F.struct(F.lit("month").alias("grain"), F.col("fiscal_period").alias("part")),
        F.struct(F.lit("quarter").alias("grain"), quarter.alias("part")),
        F.struct(F.lit("year").alias("grain"), F.lit(0).alias("part")),
    )
    return (
        monthly.withColumn("g", F.explode(grains))
        .groupBy("g.grain", "fiscal_year", "g.part", "account_type")
        .agg(
            F.sum("n").alias("transaction_count"),
            (F.sum("debit") - F.sum("credit")).cast("decimal(28,2)").alias("net_amount"),
        )
        .orderBy("grain", "fiscal_year", "part", "account_type")
    )


def pnl_summary(gl: DataFrame, accounts: DataFrame) -> DataFrame:
    """The summary table reports read instead of the ledger."""
    return _monthly_by_type(gl, accounts).select(
        "fiscal_year",
        "fiscal_period",
        "account_type",
        F.col("debit").cast("decimal(28,2)").alias("total_debits"),
        F.col("credit").cast("decimal(28,2)").alias("total_credits"),
    )


def top_cost_centers(budget: DataFrame, centers: DataFrame, year: int, n: int = 20) -> DataFrame:
    """Cost centers by average variance of one year."""
    per_center = (
        budget.where(F.col("fiscal_year") == year)
        .groupBy("cost_center")
        .agg(
            F.sum("budget_amount").alias("budget"),
            F.sum("actual_amount").alias("actual"),
            F.sum("variance_amount").alias("variance"),
            F.sum("variance_percent").alias("pct"),
            F.count("variance_percent").alias("n"),
        )
    )
    return (
        per_center.join(centers, "cost_center")
        .groupBy("cost_center", "cost_center_name", "business_unit")
        .agg(*[F.sum(c).alias(c) for c in ("budget", "actual", "variance", "pct", "n")])
        .select(
            "cost_center",
            "cost_center_name",
            "business_unit",
            scaled(F.col("budget"), MILLION).alias("total_budget_m"),
            scaled(F.col("actual"), MILLION).alias("total_actual_m"),
            scaled(F.col("variance"), MILLION).alias("total_variance_m"),
            ratio(F.col("pct"), F.col("n")).alias("avg_variance_pct"),
        )
        .orderBy(F.desc_nulls_last("avg_variance_pct"), "cost_center")
        .limit(n)
    )


def _per_vendor(invoices: DataFrame, vendors: DataFrame, vendor_columns: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Invoice aggregates per vendor id, then per vendor description (names need not be unique)."""
    per_id = invoices.groupBy("vendor_id").agg(*[agg.alias(name) for name, agg in aggs.items()])
    return (
        per_id.join(vendors.select("vendor_id", *vendor_columns), "vendor_id")
        .groupBy(*vendor_columns)
        .agg(*[F.sum(name).alias(name) for name in aggs])
    )


def vendor_payments(invoices: DataFrame, vendors: DataFrame, n: int = 25) -> DataFrame:
    """Spend, days to pay and outstanding per vendor over paid and overdue invoices."""
    days = F.datediff("payment_date", "invoice_date")
    return (
        _per_vendor(
            invoices.where(F.col("status").isin("Paid", "Overdue")),
            vendors,
            ["vendor_name", "vendor_type", "payment_terms"],
            {
                "invoice_count": F.count("invoice_id"),
                "spend": F.sum("invoice_amount"),
                "days": F.sum(days),
                "paid": F.count(days),
                "outstanding": F.sum("outstanding_amount"),
            },
        )
        .select(
            "vendor_name",
            "vendor_type",
            "payment_terms",
            "invoice_count",
            scaled(F.col("spend"), THOUSAND).alias("total_spend_k"),
            ratio(F.col("days"), F.col("paid"), 1).alias("avg_payment_days"),
            scaled(F.col("outstanding"), THOUSAND).alias("outstanding_k"),
        )
        .orderBy(F.desc("total_spend_k"), "vendor_name", "vendor_type", "payment_terms")
        .limit(n)
    )


def vendor_spend(invoices: DataFrame, vendors: DataFrame, as_of: dt.date | None = None, n: int = 25) -> DataFrame:
    """Spend per vendor over the year before ``as_of``."""
    return (
        _per_vendor(
            invoices.where(F.col("invoice_date").between(F.add_months(as_of_date(as_of), -12), as_of_date(as_of))),
            vendors,
            ["vendor_name", "vendor_type"],
            {
                "invoice_count": F.count("invoice_id"),
                "spend": F.sum("invoice_amount"),
                "priced": F.count("invoice_amount"),
                "outstanding": F.sum("outstanding_amount"),
            },
        )
        .select(
            "vendor_name",
            "vendor_type",
            "invoice_count",
            scaled(F.col("spend"), THOUSAND).alias("total_spend_k"),
            ratio(F.col("spend"), F.col("priced")).alias("avg_invoice"),
            scaled(F.col("outstanding"), THOUSAND).alias("outstanding_k"),
        )
        .orderBy(F.desc("total_spend_k"), "vendor_name", "vendor_type")
        .limit(n)
    )


def vendor_terms(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """Spend and overdue amount per vendor and its payment terms."""
    overdue = F.col("status") == "Overdue"
    return (
        _per_vendor(
            invoices,
            vendors,
            ["vendor_name", "payment_terms"],
            {
                "invoice_count": F.count(F.lit(1)),
                "spend": F.sum("invoice_amount"),
                "overdue_count": F.count_if(overdue),
                "overdue": F.coalesce(F.sum(F.when(overdue, F.col("outstanding_amount"))), F.lit(0).cast("decimal(28,2)")),
            },
        )
        .select(
            "vendor_name",
            "payment_terms",
            "invoice_count",
            F.col("spend").cast("decimal(28,2)").alias("total_spend"),
            "overdue_count",
            F.col("overdue").cast("decimal(28,2)").alias("overdue_amount"),
        )
    )


def cash_flow(invoices: DataFrame, as_of: dt.date | None = None, months: int = 6) -> DataFrame:
    """Invoices falling due per month; the amount counts open invoices only."""
    start = as_of_date(as_of)
    due_open = F.when(F.col("status") == "Open", F.col("outstanding_amount")).otherwise(F.lit(0).cast("decimal(18,2)"))
    return (
        invoices.where(F.col("due_date").between(start, F.add_months(start, months)))
        .groupBy(F.date_format("due_date", "yyyy-MM").alias("due_month"))
        .agg(F.count(F.lit(1)).alias("invoice_count"), scaled(F.sum(due_open), MILLION).alias("payables_due_m"))
        .orderBy("due_month")
    )


def ledger_by_year(gl: DataFrame) -> DataFrame:
    """Volume, sums and distinct accounts and centers per fiscal year.

    Two aggregates, each combined map-side to (year, account) and (year, center). One aggregate
    with two distinct counts would triple every ledger row first; the second scan here reads two
    columns.
    """
    per_account = gl.groupBy("fiscal_year", "account_number").agg(
        F.count(F.lit(1)).alias("n"), F.sum("debit_amount").alias("debit"), F.sum("credit_amount").alias("credit")
    )
    accounts = per_account.groupBy("fiscal_year").agg(
        F.sum("n").alias("n"),
        F.sum("debit").cast("decimal(28,2)").alias("debit"),
        F.sum("credit").cast("decimal(28,2)").alias("credit"),
        F.count("account_number").alias("accounts"),
    )
    centers = gl.select("fiscal_year", "cost_center").distinct().groupBy("fiscal_year").agg(F.count("cost_center").alias("centers"))
    return (
        accounts.unionByName(centers, allowMissingColumns=True)
        .groupBy("fiscal_year")
        .agg(
            F.sum("n").alias("transaction_count"),
            F.sum("debit").cast("decimal(28,2)").alias("total_debits"),
            F.sum("credit").cast("decimal(28,2)").alias("total_credits"),
            F.sum("accounts").alias("unique_accounts"),
            F.sum("centers").alias("unique_cost_centers"),
        )
        .orderBy(F.desc("fiscal_year"))
    )


def invoices_by_year(
    invoices: DataFrame,
    as_of: dt.date | None = None,
    years: int = 2,
    cost_center: str | None = None,
    vendor_id: int | None = None,
) -> DataFrame:
    """Invoice amount per year over the last ``years``, optionally of one center or vendor."""
    df = invoices.where(F.col("invoice_date").between(F.add_months(as_of_date(as_of), -12 * years), as_of_date(as_of)))
    if cost_center is not None:
        df = df.where(F.col("cost_center") == cost_center)
    if vendor_id is not None:
        df = df.where(F.col("vendor_id") == vendor_id)
    return (
        df.groupBy(F.year("invoice_date").alias("invoice_year"))
        .agg(F.count(F.lit(1)).alias("invoice_count"), F.sum("invoice_amount").cast("decimal(28,2)").alias("total_amount"))
        .orderBy("invoice_year")
    )


def _center_months(budget: DataFrame) -> DataFrame:
    return budget.groupBy("cost_center", "fiscal_year", "fiscal_period").agg(
        F.sum("budget_amount").cast("decimal(28,2)").alias("budget"),
        F.sum("actual_amount").cast("decimal(28,2)").alias("actual"),
    )


def variance_trend(budget: DataFrame) -> DataFrame:
    """Variance per center and month, and its change against the month before."""
    months = Window.partitionBy("cost_center").orderBy("fiscal_year", "fiscal_period")
    variance = (F.col("actual") - F.col("budget")).cast("decimal(28,2)")
    return (
        _center_months(budget)
        .withColumn("variance", variance)
        .select(
            "cost_center",
            "fiscal_year",
            "fiscal_period",
            "variance",
            safe_percent(F.col("variance"), F.col("budget")).alias("variance_pct"),
            (F.col("variance") - F.lag("variance").over(months)).cast("decimal(28,2)").alias("change"),
        )
    )


def year_to_date(budget: DataFrame) -> DataFrame:
    """Running actual and variance within each center's fiscal year."""
    so_far = (
        Window.partitionBy("cost_center", "fiscal_year")
        .orderBy("fiscal_period")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    months = _center_months(budget)
    return months.select(
        "cost_center",
        "fiscal_year",
        "fiscal_period",
        F.sum("actual").over(so_far).cast("decimal(28,2)").alias("actual_ytd"),
        (F.sum("actual").over(so_far) - F.sum("budget").over(so_far)).cast("decimal(28,2)").alias("variance_ytd"),
    )


def ledger_sample(gl: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` rows in seeded random order.

    The order is MD5 of seed and row, so every row is drawn for itself, also among rows of one key or of
    none, and both sides of a copy, whatever engine holds them, draw the same rows. Rows of one digest
    follow by what they show. Spark hashes each row once and keeps ``n`` rows per task (TakeOrderedAndProject).
    """
    shown = gl.select(
        "transaction_id", "transaction_date", "fiscal_year", "fiscal_period", "account_number",
        money(F.col("debit_amount")).alias("debit_amount"), money(F.col("credit_amount")).alias("credit_amount"), "description",
    )
    text = F.concat_ws(
        "|", F.lit(str(seed)), F.col("transaction_id").cast("string"), F.col("transaction_date").cast("string"),
        F.col("account_number"), F.col("debit_amount").cast("string"), F.col("credit_amount").cast("string"),
    )
    return shown.withColumn("_place", F.md5(text)).orderBy("_place", *shown.columns).limit(n).drop("_place")
