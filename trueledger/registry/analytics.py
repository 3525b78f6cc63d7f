"""Finance analytics by name."""

from __future__ import annotations

import datetime as dt

from trueledger.plans import analytics as A
from trueledger.registry import query
from trueledger.registry.ctes import cents, exact_ratio, scaled, with_views
from trueledger.session import work_dir
from trueledger.sources import testviews as V

AS_OF = dt.date(2001, 3, 1)
PNL_COLUMNS = ["transaction_date", "fiscal_year", "fiscal_period", "account_number", "debit_amount", "credit_amount"]


def _pnl_inputs(spark, sf_dir):
    return V.gl_transactions(spark, sf_dir, PNL_COLUMNS), V.chart_of_accounts(spark, sf_dir)


@query(
    "q01_monthly_pnl",
    with_views(
        "gl coa",
        f"""SELECT fiscal_year, fiscal_period, account_type, COUNT(*) AS transaction_count,
        {scaled('SUM(debit_amount - credit_amount)', A.MILLION)} AS net_amount_m
        FROM gl JOIN coa USING (account_number) WHERE fiscal_year >= 1999 GROUP BY 1, 2, 3 ORDER BY 1 DESC, 2 DESC, 3""",
    ),
)
def q01(spark, sf_dir):
    return A.monthly_pnl(*_pnl_inputs(spark, sf_dir), first_year=1999)


@query(
    "q02_top_cost_centers",
    with_views(
        "bud cc",
        f"""SELECT cost_center, cost_center_name, business_unit,
        {scaled('SUM(budget_amount)', A.MILLION)} AS total_budget_m, {scaled('SUM(actual_amount)', A.MILLION)} AS total_actual_m,
        {scaled('SUM(variance_amount)', A.MILLION)} AS total_variance_m,
        {exact_ratio(cents('SUM(variance_percent)'), 'COUNT(variance_percent)')} AS avg_variance_pct
        FROM bud JOIN cc USING (cost_center) WHERE fiscal_year = 2000 GROUP BY 1, 2, 3
        ORDER BY avg_variance_pct DESC, cost_center LIMIT 20""",
    ),
)
def q02(spark, sf_dir):
    return A.top_cost_centers(V.budget_actual(spark, sf_dir), V.cost_centers(spark, sf_dir), 2000)


@query(
    "q03_vendor_payments",
    with_views(
        "inv vendors",
        f"""SELECT vendor_name, vendor_type, payment_terms, COUNT(invoice_id) AS invoice_count,
        {scaled('SUM(invoice_amount)', A.THOUSAND)} AS total_spend_k,
        {exact_ratio("100 * SUM(date_diff('day', invoice_date, payment_date))", "NULLIF(COUNT(payment_date), 0)", 1)} AS avg_payment_days,
        {scaled('SUM(outstanding_amount)', A.THOUSAND)} AS outstanding_k
        FROM inv JOIN vendors USING (vendor_id) WHERE status IN ('Paid', 'Overdue') GROUP BY 1, 2, 3
        ORDER BY total_spend_k DESC, 1, 2, 3 LIMIT 25""",
    ),
)
def q03(spark, sf_dir):
    return A.vendor_payments(V.invoices(spark, sf_dir), V.vendors(spark, sf_dir))


@query(
    "q04_cash_flow",
    with_views(
        "inv",
        f"""SELECT strftime(due_date, '%Y-%m') AS due_month, COUNT(*) AS invoice_count,
        {scaled("SUM(CASE WHEN status = 'Open' THEN outstanding_amount ELSE 0 END)", A.MILLION)} AS payables_due_m
        FROM inv WHERE due_date BETWEEN DATE '2001-03-01' AND DATE '2001-09-01' GROUP BY 1 ORDER BY 1""",
    ),
)
def q04(spark, sf_dir):
    return A.cash_flow(V.invoices(spark, sf_dir), AS_OF)


@query(
    "q05_vendor_spend",
    with_views(
        "inv vendors",
        f"""SELECT vendor_name, vendor_type, COUNT(invoice_id) AS invoice_count, {scaled('SUM(invoice_amount)', A.THOUSAND)} AS total_spend_k,
        {exact_ratio(cents('SUM(invoice_amount)'), 'COUNT(invoice_amount)')} AS avg_invoice,
        {scaled('SUM(outstanding_amount)', A.THOUSAND)} AS outstanding_k
        FROM inv JOIN vendors USING (vendor_id) WHERE invoice_date BETWEEN DATE '2000-03-01' AND DATE '2001-03-01' GROUP BY 1, 2
        ORDER BY total_spend_k DESC, 1, 2 LIMIT 25""",
    ),
)
def q05(spark, sf_dir):
    return A.vendor_spend(V.invoices(spark, sf_dir), V.vendors(spark, sf_dir), AS_OF)


@query(
    "q06_ledger_by_year",
    with_views(
        "gl",
        """SELECT fiscal_year, COUNT(*) AS transaction_count, CAST(SUM(debit_amount) AS DECIMAL(28,2)) AS total_debits,
        CAST(SUM(credit_amount) AS DECIMAL(28,2)) AS total_credits, COUNT(DISTINCT account_number) AS unique_accounts,
        COUNT(DISTINCT cost_center) AS unique_cost_centers FROM gl GROUP BY 1 ORDER BY 1 DESC""",
    ),
)
def q06(spark, sf_dir):
    cols = ["fiscal_year", "account_number", "cost_center", "debit_amount", "credit_amount"]
    return A.ledger_by_year(V.gl_transactions(spark, sf_dir, cols))


@query(
    "q07_invoices_by_year",
    with_views(
        "inv",
        """SELECT CAST(year(invoice_date) AS INTEGER) AS invoice_year, COUNT(*) AS invoice_count,
        CAST(SUM(invoice_amount) AS DECIMAL(28,2)) AS total_amount
        FROM inv WHERE invoice_date BETWEEN DATE '1999-03-01' AND DATE '2001-03-01' AND cost_center = 'CC1003' GROUP BY 1 ORDER BY 1""",
    ),
)
def q07(spark, sf_dir):
    return A.invoices_by_year(V.invoices(spark, sf_dir), AS_OF, 2, cost_center="CC1003")


@query(
    "q08_pnl_by_grain",
    with_views(
        "gl coa",
        """, m AS (SELECT fiscal_year, fiscal_period, account_type, debit_amount - credit_amount AS net FROM gl JOIN coa USING (account_number)),
        g AS (SELECT 'month' AS grain, fiscal_year, fiscal_period AS part, account_type, net FROM m
        UNION ALL SELECT 'quarter', fiscal_year, (fiscal_period + 2) // 3, account_type, net FROM m
        UNION ALL SELECT 'year', fiscal_year, 0, account_type, net FROM m)
        SELECT grain, fiscal_year, CAST(part AS INTEGER) AS part, account_type, COUNT(*) AS transaction_count,
        CAST(SUM(net) AS DECIMAL(28,2)) AS net_amount FROM g GROUP BY 1, 2, 3, 4""",
    ),
)
def q08(spark, sf_dir):
    return A.pnl_by_grain(*_pnl_inputs(spark, sf_dir))


@query(
    "q09_variance_trend",
    with_views(
        "bud",
        """, m AS (SELECT cost_center, fiscal_year, fiscal_period, SUM(budget_amount) AS b, SUM(variance_amount) AS v, SUM(variance_percent) AS p
          FROM bud GROUP BY 1, 2, 3)
        SELECT cost_center, fiscal_year, fiscal_period, CAST(v AS DECIMAL(28,2)) AS variance, CAST(p AS DECIMAL(18,2)) AS variance_pct,
        CAST(v - LAG(v) OVER (PARTITION BY cost_center ORDER BY fiscal_year, fiscal_period) AS DECIMAL(28,2)) AS change FROM m""",
    ),
)
def q09(spark, sf_dir):
    return A.variance_trend(V.budget_actual(spark, sf_dir))


@query(
    "q10_vendor_terms",
    with_views(
        "inv vendors",
        """SELECT vendor_name, payment_terms, COUNT(*) AS invoice_count, CAST(SUM(invoice_amount) AS DECIMAL(28,2)) AS total_spend,
        COUNT(*) FILTER (status = 'Overdue') AS overdue_count,
        CAST(COALESCE(SUM(outstanding_amount) FILTER (status = 'Overdue'), 0) AS DECIMAL(28,2)) AS overdue_amount
        FROM inv JOIN vendors USING (vendor_id) GROUP BY 1, 2""",
    ),
)
def q10(spark, sf_dir):
    return A.vendor_terms(V.invoices(spark, sf_dir), V.vendors(spark, sf_dir))


@query(
    "q11_year_to_date",
    with_views(
        "bud",
        """SELECT cost_center, fiscal_year, fiscal_period,
        CAST(SUM(actual_amount) OVER w AS DECIMAL(28,2)) AS actual_ytd, CAST(SUM(variance_amount) OVER w AS DECIMAL(28,2)) AS variance_ytd
        FROM bud WINDOW w AS (PARTITION BY cost_center, fiscal_year ORDER BY fiscal_period)""",
    ),
)
def q11(spark, sf_dir):
    return A.year_to_date(V.budget_actual(spark, sf_dir))


@query(
    "a07_summary",
    with_views(
        "gl coa",
        """SELECT fiscal_year, fiscal_period, account_type, CAST(SUM(debit_amount) AS DECIMAL(28,2)) AS total_debits,
        CAST(SUM(credit_amount) AS DECIMAL(28,2)) AS total_credits FROM gl JOIN coa USING (account_number) GROUP BY 1, 2, 3""",
    ),
)
def a07(spark, sf_dir):
    path = work_dir(spark, "pnl-summary")
    A.pnl_summary(*_pnl_inputs(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "o03_seeded_sample",
    with_views(
        "gl",
        """SELECT transaction_id, transaction_date, fiscal_year, fiscal_period, account_number, CAST(debit_amount AS DECIMAL(18,2)) AS debit_amount,
        CAST(credit_amount AS DECIMAL(18,2)) AS credit_amount, description FROM gl
        ORDER BY md5(concat_ws('|', '42', transaction_id, transaction_date, account_number, CAST(debit_amount AS DECIMAL(18,2)), CAST(credit_amount AS DECIMAL(18,2)))) LIMIT 10""",
    ),
)
def o03(spark, sf_dir):
    cols = PNL_COLUMNS + ["transaction_id", "description"]
    return A.ledger_sample(V.gl_transactions(spark, sf_dir, cols), 10, 42)
