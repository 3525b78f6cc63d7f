"""The six finance tables: columns, types, keys and foreign keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in cols])


GL_TRANSACTIONS = _schema(
    ("transaction_id", T.LongType()),
    ("transaction_date", T.DateType()),
    ("posting_date", T.DateType()),
    ("fiscal_year", T.IntegerType()),
    ("fiscal_period", T.IntegerType()),
    ("account_number", T.StringType()),
    ("account_name", T.StringType()),
    ("cost_center", T.StringType()),
    ("department", T.StringType()),
    ("debit_amount", MONEY),
    ("credit_amount", MONEY),
    ("currency_code", T.StringType()),
    ("description", T.StringType()),
    ("source_system", T.StringType()),
    ("created_by", T.StringType()),
    ("created_timestamp", T.TimestampNTZType()),
)

INVOICES = _schema(
    ("invoice_id", T.LongType()),
    ("invoice_number", T.StringType()),
    ("vendor_id", T.LongType()),
    ("invoice_date", T.DateType()),
    ("due_date", T.DateType()),
    ("payment_date", T.DateType()),
    ("invoice_amount", MONEY),
    ("paid_amount", MONEY),
    ("outstanding_amount", MONEY),
    ("status", T.StringType()),
    ("cost_center", T.StringType()),
    ("account_number", T.StringType()),
)

BUDGET_ACTUAL = _schema(
    ("budget_id", T.LongType()),
    ("cost_center", T.StringType()),
    ("fiscal_year", T.IntegerType()),
    ("fiscal_period", T.IntegerType()),
    ("budget_amount", MONEY),
    ("actual_amount", MONEY),
    ("variance_amount", MONEY),
    ("variance_percent", MONEY),
)

VENDORS = _schema(
    ("vendor_id", T.LongType()),
    ("vendor_name", T.StringType()),
    ("vendor_type", T.StringType()),
    ("payment_terms", T.StringType()),
)

COST_CENTERS = _schema(
    ("cost_center", T.StringType()),
    ("cost_center_name", T.StringType()),
    ("business_unit", T.StringType()),
)

CHART_OF_ACCOUNTS = _schema(
    ("account_number", T.StringType()),
    ("account_name", T.StringType()),
    ("account_type", T.StringType()),
)

# Load order: small tables first.
TABLES: dict[str, T.StructType] = {
    "chart_of_accounts": CHART_OF_ACCOUNTS,
    "cost_centers": COST_CENTERS,
    "vendors": VENDORS,
    "budget_actual": BUDGET_ACTUAL,
    "invoices": INVOICES,
    "gl_transactions": GL_TRANSACTIONS,
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "chart_of_accounts": ["account_number"],
    "cost_centers": ["cost_center"],
    "vendors": ["vendor_id"],
    "budget_actual": ["budget_id"],
    "invoices": ["invoice_id"],
    "gl_transactions": ["transaction_id"],
}


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column}->{self.parent}"


FOREIGN_KEYS = [
    ForeignKey("invoices", "vendor_id", "vendors"),
    ForeignKey("gl_transactions", "cost_center", "cost_centers"),
    ForeignKey("gl_transactions", "account_number", "chart_of_accounts"),
    ForeignKey("budget_actual", "cost_center", "cost_centers"),
]

REQUIRED_COLUMNS: dict[str, list[str]] = {
    "gl_transactions": ["transaction_id", "transaction_date", "debit_amount", "credit_amount"],
    "invoices": ["invoice_id", "vendor_id", "invoice_date", "invoice_amount", "status"],
    "budget_actual": ["budget_id", "cost_center", "fiscal_year", "budget_amount", "actual_amount"],
    "vendors": ["vendor_id", "vendor_name"],
    "cost_centers": ["cost_center", "cost_center_name"],
    "chart_of_accounts": ["account_number", "account_type"],
}

CHECK_RESULT = _schema(
    ("check_id", T.StringType()),
    ("category", T.StringType()),
    ("entity", T.StringType()),
    ("metric", T.StringType()),
    ("expected", T.DecimalType(38, 6)),
    ("actual", T.DecimalType(38, 6)),
    ("status", T.StringType()),
    ("detail", T.StringType()),
)
