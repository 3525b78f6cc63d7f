"""Synthetic finance tables, generated where they are used.

Every value is a hash of (row id, seed, column), so a seed gives the same tables for any number of
partitions and any executor can rebuild a lost partition.
"""

from __future__ import annotations

import math
import zlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trueledger.functions import money, safe_percent
from trueledger.schemas import TABLES

# Rows per table at full size, and the default seed.
FULL_SIZE = {
    "chart_of_accounts": 2_000,
    "cost_centers": 1_000,
    "vendors": 10_000,
    "budget_actual": 500_000,
    "invoices": 15_000_000,
    "gl_transactions": 30_000_000,
}
SEED = 42
FIRST_DAY, DAYS = "2022-01-01", 1096
ROWS_PER_PARTITION = 1_000_000


def uniform(seed: int, column: str, low: int, high: int, key: str = "id") -> Column:
    """A whole number between ``low`` and ``high``, both included, fixed by row, seed and column."""
    return F.lit(low) + F.pmod(F.xxhash64(F.col(key), F.lit(seed), F.lit(column)), F.lit(high - low + 1))


def _pick(seed: int, column: str, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), uniform(seed, column, 1, len(values)).cast("int"))


def _amount(seed: int, column: str, low: int, high: int) -> Column:
    """Money between two whole amounts, to the cent."""
    return money(uniform(seed, column, low * 100, high * 100).cast("decimal(20,0)") / 100)


def _day(seed: int, column: str) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), uniform(seed, column, 0, DAYS - 1).cast("int"))


def _center(number: Column) -> Column:
    return F.concat(F.lit("CC"), (number + 1000).cast("string"))


def row_ids(spark: SparkSession, n: int) -> DataFrame:
    """Ids 0..n-1, split so that a partition holds about a million rows."""
    return spark.range(0, n, 1, max(1, -(-n // ROWS_PER_PARTITION)))


def accounts(ids: DataFrame, seed: int = SEED) -> DataFrame:
    return ids.select(
        (F.col("id") + 1000).cast("string").alias("account_number"),
        F.concat(F.lit("Account "), F.col("id").cast("string")).alias("account_name"),
        _pick(seed, "account_type", ["Asset", "Liability", "Equity", "Revenue", "Expense"]).alias("account_type"),
    )


def centers(ids: DataFrame, seed: int = SEED) -> DataFrame:
    return ids.select(
        _center(F.col("id")).alias("cost_center"),
        F.concat(F.lit("Center "), F.col("id").cast("string")).alias("cost_center_name"),
        _pick(seed, "business_unit", ["Corporate", "Operations", "Sales", "Research", "Services"]).alias("business_unit"),
    )


def vendors(ids: DataFrame, seed: int = SEED) -> DataFrame:
    return ids.select(
        (F.col("id") + 1).alias("vendor_id"),
        F.concat(F.lit("Vendor "), F.lpad((F.col("id") + 1).cast("string"), 8, "0")).alias("vendor_name"),
        _pick(seed, "vendor_type", ["Goods", "Services", "Utilities", "Contractor"]).alias("vendor_type"),
        _pick(seed, "payment_terms", ["NET30", "NET45", "NET60"]).alias("payment_terms"),
    )


def budget(ids: DataFrame, n_centers: int, seed: int = SEED) -> DataFrame:
    planned, actual = _amount(seed, "budget", 1_000, 500_000), _amount(seed, "actual", 1_000, 500_000)
    base = ids.select(
        (F.col("id") + 1).alias("budget_id"),
        _center(uniform(seed, "center", 0, n_centers - 1)).alias("cost_center"),
        uniform(seed, "year", 2022, 2024).cast("int").alias("fiscal_year"),
        uniform(seed, "period", 1, 12).cast("int").alias("fiscal_period"),
        planned.alias("budget_amount"),
        actual.alias("actual_amount"),
    )
    variance = money(F.col("actual_amount") - F.col("budget_amount"))
    return base.select(
        "*", variance.alias("variance_amount"), safe_percent(variance, F.col("budget_amount")).alias("variance_percent")
    )


def invoices(ids: DataFrame, n_vendors: int, n_centers: int, n_accounts: int, seed: int = SEED) -> DataFrame:
    """Statuses in the proportions 60/20/15/5; paid and outstanding amounts follow the status."""
    draw = uniform(seed, "status", 1, 100)
    status = F.when(draw <= 60, "Paid").when(draw <= 80, "Open").when(draw <= 95, "Overdue").otherwise("Cancelled")
    base = ids.select(
        (F.col("id") + 1).alias("invoice_id"),
        F.concat(F.lit("INV-"), F.lpad((F.col("id") + 1).cast("string"), 12, "0")).alias("invoice_number"),
        uniform(seed, "vendor", 1, n_vendors).alias("vendor_id"),
        _day(seed, "invoice_date").alias("invoice_date"),
        uniform(seed, "days_to_pay", 5, 75).cast("int").alias("_days"),
        _amount(seed, "amount", 500, 100_000).alias("invoice_amount"),
        status.alias("status"),
        _center(uniform(seed, "center", 0, n_centers - 1)).alias("cost_center"),
        uniform(seed, "account", 1000, 999 + n_accounts).cast("string").alias("account_number"),
    )
    return _invoice_columns(base)


def _invoice_columns(base: DataFrame) -> DataFrame:
    """Due date, payment and amounts as they follow from status, day and ``_days`` to pay."""
    zero = money(F.lit(0))
    return base.select(
        "invoice_id",
        "invoice_number",
        "vendor_id",
        "invoice_date",
        F.date_add("invoice_date", 30).alias("due_date"),
        F.when(F.col("status") == "Paid", F.date_add("invoice_date", F.col("_days"))).alias("payment_date"),
        "invoice_amount",
        F.when(F.col("status") == "Paid", F.col("invoice_amount")).otherwise(zero).alias("paid_amount"),
        F.when(F.col("status").isin("Open", "Overdue"), F.col("invoice_amount")).otherwise(zero).alias("outstanding_amount"),
        "status",
        "cost_center",
        "account_number",
    )


def gl(ids: DataFrame, n_accounts: int, n_centers: int, seed: int = SEED) -> DataFrame:
    """Ledger lines in pairs: even and odd row of a pair carry the same amount, as debit and credit."""
    pair = ids.withColumn("pair", F.floor(F.col("id") / 2).cast("bigint")).withColumn("is_debit", F.col("id") % 2 == 0)
    amount = money(uniform(seed, "amount", 100, 5_000_000, "pair").cast("decimal(20,0)") / 100)
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), uniform(seed, "day", 0, DAYS - 1, "pair").cast("int"))
    account = uniform(seed, "account", 1000, 999 + n_accounts)
    zero = money(F.lit(0))
    base = pair.select(
        "*", amount.alias("amount"), day.alias("transaction_date"), account.cast("string").alias("account_number"),
        _center(uniform(seed, "center", 0, n_centers - 1)).alias("cost_center"),
    )
    return base.select(
        (F.col("id") + 1).alias("transaction_id"),
        "transaction_date",
        F.date_add("transaction_date", uniform(seed, "lag", 0, 3).cast("int")).alias("posting_date"),
        F.year("transaction_date").alias("fiscal_year"),
        F.month("transaction_date").alias("fiscal_period"),
        "account_number",
        F.concat(F.lit("Account "), F.col("account_number")).alias("account_name"),
        "cost_center",
        F.concat(F.lit("D"), uniform(seed, "department", 1, 20).cast("string")).alias("department"),
        F.when(F.col("is_debit"), F.col("amount")).otherwise(zero).alias("debit_amount"),
        F.when(F.col("is_debit"), zero).otherwise(F.col("amount")).alias("credit_amount"),
        F.lit("USD").alias("currency_code"),
        F.concat(F.lit("Entry "), F.col("pair").cast("string")).alias("description"),
        _pick(seed, "source", ["AP", "AR", "GL", "PAYROLL"]).alias("source_system"),
        F.lit("loader").alias("created_by"),
        F.col("transaction_date").cast("timestamp_ntz").alias("created_timestamp"),
    )


def sizes(rows: dict[str, int] | None = None, scale: float = 1.0) -> dict[str, int]:
    """Rows per table: the full sizes, or ``rows``, times ``scale``; none is raised or lowered."""
    return {name: int((rows or FULL_SIZE)[name] * scale) for name in TABLES}


def generate(spark: SparkSession, rows: dict[str, int] | None = None, scale: float = 1.0, seed: int = SEED) -> dict[str, DataFrame]:
    """All six tables, lazily. ``rows`` overrides the full sizes, ``scale`` multiplies them."""
    n = sizes(rows, scale)
    ids = {name: row_ids(spark, n[name]) for name in TABLES}
    n_accounts, n_centers = n["chart_of_accounts"], n["cost_centers"]
    return {
        "chart_of_accounts": accounts(ids["chart_of_accounts"], seed),
        "cost_centers": centers(ids["cost_centers"], seed),
        "vendors": vendors(ids["vendors"], seed),
        "budget_actual": budget(ids["budget_actual"], n_centers, seed),
        "invoices": invoices(ids["invoices"], n["vendors"], n_centers, n_accounts, seed),
        "gl_transactions": gl(ids["gl_transactions"], n_accounts, n_centers, seed),
    }


def weighted_ranges(given: DataFrame, column: str, parts: int = 1024) -> DataFrame:
    """``value, lo, hi``: each value of ``column`` with as many places of 0..rows-1 as rows that have it.

    Places are summed within hash parts of the values, then over the parts, so no task holds all values.
    """
    counts = given.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(parts)))
    ends = F.sum("n").over(Window.partitionBy("part").orderBy("value"))
    totals = counts.groupBy("part").agg(F.sum("n").alias("held"))  # ``parts`` rows at most
    starts = totals.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("start"))
    placed = counts.withColumn("hi", ends).join(starts, "part")
    return placed.select("value", (F.col("start") + F.col("hi") - F.col("n")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))


def drawn_like(ids: DataFrame, n: int, given: DataFrame, column: str, seed: int = SEED) -> DataFrame:
    """``ids`` (0..n-1) with ``column`` drawn with the shares that its values have among the ``given`` rows.

    The draw is systematic: a permutation of the ids is laid evenly over the given rows' places, so every
    value gets its share of ``n``, rounded up or down. Places meet the values' ranges in buckets of the mean
    width of a range: a value with a large share spans many buckets, none of which is larger than others.
    """
    sized = given.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.coalesce(F.xxhash64(column), F.lit(0))).alias("values")).head()
    if not sized["rows"]:
        raise ValueError(f"no given row to draw {column} from")
    total, width = sized["rows"], max(1, sized["rows"] // max(sized["values"], 1))
    step, shift = _coprime(n, seed, column), zlib.crc32(f"{seed}:{column}".encode()) % max(n, 1)
    spread = F.pmod(F.col("id") * F.lit(step) + F.lit(shift), F.lit(max(n, 1)))
    place = F.floor(spread.cast("decimal(19,0)") * F.lit(total).cast("decimal(19,0)") / F.lit(max(n, 1)).cast("decimal(19,0)")).cast("bigint")
    draws = ids.withColumn("_place", place).withColumn("_bucket", F.floor(F.col("_place") / width).cast("bigint"))
    buckets = F.sequence(F.floor(F.col("lo") / width).cast("bigint"), F.floor((F.col("hi") - 1) / width).cast("bigint"))
    ranges = weighted_ranges(given, column).select(F.col("value").alias(column), "lo", "hi", F.explode(buckets).alias("_bucket"))
    inside = (F.col("_place") >= F.col("lo")) & (F.col("_place") < F.col("hi"))
    return draws.join(ranges, "_bucket").where(inside).drop("_bucket", "_place", "lo", "hi")


def _coprime(n: int, seed: int, column: str) -> int:
    """A number that no prime of ``n`` divides, fixed by seed and column; below 2^21, so that products stay whole."""
    step = 1 + zlib.crc32(f"{column}:{seed}".encode()) % (1 << 20)
    while math.gcd(step, n) != 1:
        step += 1
    return step


def invoices_like(spark: SparkSession, given: DataFrame, n: int, seed: int = SEED) -> DataFrame:
    """``n`` invoices whose vendors, centers, accounts, statuses and days have the shares of the ``given`` ones."""
    ids = row_ids(spark, n)
    for column in ("vendor_id", "cost_center", "account_number", "status", "invoice_date"):
        ids = drawn_like(ids, n, given, column, seed)
    return _invoice_columns(
        ids.select(
            (F.col("id") + 1).alias("invoice_id"),
            F.concat(F.lit("INV-"), F.lpad((F.col("id") + 1).cast("string"), 12, "0")).alias("invoice_number"),
            "vendor_id", "invoice_date", "status", "cost_center", "account_number",
            uniform(seed, "days_to_pay", 5, 75).cast("int").alias("_days"),
            _amount(seed, "amount", 500, 100_000).alias("invoice_amount"),
        )
    )


# Fixed values in the test rows below: the ranges that the sync test draws from.
def test_invoices(spark: SparkSession, first_id: Column, n: int, day: Column, seed: int = SEED) -> DataFrame:
    """``n`` open invoices numbered after ``first_id``, for testing an incremental sync.

    Amount and outstanding are drawn independently, as the sync test defines them.
    """
    number = F.concat(F.lit("INV-TEST-"), F.lpad((F.col("id") + 1).cast("string"), 6, "0"))
    return row_ids(spark, n).select(
        (first_id + F.col("id") + 1).alias("invoice_id"),
        number.alias("invoice_number"),
        uniform(seed, "vendor", 1, 1000).alias("vendor_id"),
        F.date_sub(day, 30).alias("invoice_date"),
        day.alias("due_date"),
        F.lit(None).cast("date").alias("payment_date"),
        money(uniform(seed, "amount", 1000, 50_000)).alias("invoice_amount"),
        money(F.lit(0)).alias("paid_amount"),
        money(uniform(seed, "outstanding", 1000, 50_000)).alias("outstanding_amount"),
        F.lit("Open").alias("status"),
        F.concat(F.lit("CC"), uniform(seed, "center", 1000, 1199).cast("string")).alias("cost_center"),
        uniform(seed, "account", 1000, 1499).cast("string").alias("account_number"),
    )


def mark_even_paid(invoices: DataFrame, day: Column) -> DataFrame:
    """The update batch of the sync test: test invoices with an even id become paid."""
    hit = invoices.where(F.col("invoice_number").like("INV-TEST-%") & (F.col("invoice_id") % 2 == 0))
    return hit.withColumns(
        {
            "status": F.lit("Paid"),
            "payment_date": day,
            "paid_amount": F.col("invoice_amount"),
            "outstanding_amount": money(F.lit(0)),
        }
    )
