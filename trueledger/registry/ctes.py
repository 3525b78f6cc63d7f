"""SQL text of the finance views, for checking the Spark jobs against an independent engine."""

from __future__ import annotations

def exact_ratio(cents: str, den: str, scale: int = 2) -> str:
    """``cents / 100 / den`` rounded half away from zero, in whole-number arithmetic only."""
    k = 10 ** (scale - 2) if scale >= 2 else None
    num = f"(CAST({cents} AS HUGEINT) * {k})" if k else f"(CAST({cents} AS HUGEINT))"
    d = f"(CAST({den} AS HUGEINT))" if k else f"(CAST({den} AS HUGEINT) * {10 ** (2 - scale)})"
    whole = f"sign({num}) * ((2 * abs({num}) + {d}) // (2 * {d}))"
    return f"CAST(CAST({whole} AS DECIMAL(38,0)) * CAST({1 / 10**scale:.{scale}f} AS DECIMAL(10,{scale})) AS DECIMAL(18,{scale}))"


def cents(expr: str) -> str:
    """A DECIMAL(…,2) as a whole number of cents."""
    return f"CAST(CAST({expr} AS DECIMAL(36,2)) * 100 AS HUGEINT)"


def scaled(expr: str, unit: int, scale: int = 2) -> str:
    return exact_ratio(cents(expr), str(unit), scale)


PERCENT = exact_ratio(f"{cents('actual_amount - budget_amount')} * 10000", cents("budget_amount"))
DAY = "CAST(l_shipdate AS DATE)"

# name -> (names it needs, body). Role names, addresses and access levels in them are fixed values.
VIEWS: dict[str, tuple[list[str], str]] = {
    "coa": ([], "SELECT CAST(p_partkey AS VARCHAR) AS account_number, p_name AS account_name, p_type AS account_type FROM part"),
    "cc": (
        [],
        "SELECT 'CC' || CAST(1000 + n_nationkey AS VARCHAR) AS cost_center, n_name AS cost_center_name, r_name AS business_unit "
        "FROM nation JOIN region ON n_regionkey = r_regionkey",
    ),
    "vendors": (
        [],
        "SELECT c_custkey AS vendor_id, c_name AS vendor_name, c_mktsegment AS vendor_type, "
        "CASE c_nationkey % 3 WHEN 0 THEN 'NET30' WHEN 1 THEN 'NET45' ELSE 'NET60' END AS payment_terms FROM customer",
    ),
    "inv0": (
        [],
        """SELECT o_orderkey AS invoice_id, 'INV-' || o_orderkey AS invoice_number, o_custkey AS vendor_id,
        CAST(o_orderdate AS DATE) AS invoice_date, CAST(o_totalprice AS DECIMAL(18,2)) AS invoice_amount,
        CASE WHEN o_orderkey % 20 = 0 THEN 'Cancelled' WHEN o_orderstatus = 'F' THEN 'Paid'
             WHEN o_orderstatus = 'O' THEN 'Open' WHEN o_orderstatus = 'P' THEN 'Overdue' END AS status
        FROM orders""",
    ),
    "inv": (
        ["inv0"],
        """SELECT invoice_id, invoice_number, vendor_id, invoice_date, CAST(invoice_date + 30 AS DATE) AS due_date,
        CASE WHEN status = 'Paid' THEN CAST(invoice_date + CAST(invoice_id % 60 AS INTEGER) AS DATE) END AS payment_date,
        invoice_amount,
        CASE WHEN status = 'Paid' THEN invoice_amount ELSE CAST(0 AS DECIMAL(18,2)) END AS paid_amount,
        CASE WHEN status IN ('Open', 'Overdue') THEN invoice_amount ELSE CAST(0 AS DECIMAL(18,2)) END AS outstanding_amount,
        status, 'CC' || CAST(1000 + invoice_id % 25 AS VARCHAR) AS cost_center,
        CAST(1000 + invoice_id % 500 AS VARCHAR) AS account_number
        FROM inv0""",
    ),
    "gl": (
        [],
        f"""SELECT l_orderkey * 10 + l_linenumber AS transaction_id, {DAY} AS transaction_date,
        CAST({DAY} + l_linenumber AS DATE) AS posting_date,
        CAST(year(l_shipdate) AS INTEGER) AS fiscal_year, CAST(month(l_shipdate) AS INTEGER) AS fiscal_period,
        CAST(l_partkey AS VARCHAR) AS account_number, 'Account ' || l_partkey AS account_name,
        'CC' || CAST(1000 + s_nationkey AS VARCHAR) AS cost_center, 'D' || l_linenumber AS department,
        CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END AS debit_amount,
        CASE WHEN l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END AS credit_amount,
        'USD' AS currency_code, 'Line ' || l_linenumber || ' of ' || l_orderkey AS description,
        CASE l_returnflag WHEN 'A' THEN 'AP' WHEN 'R' THEN 'AR' ELSE 'GL' END AS source_system,
        'loader' AS created_by, l_shipdate AS created_timestamp
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    ),
    "bud0": (
        [],
        """SELECT s_nationkey, CAST(year(l_shipdate) AS INTEGER) AS fiscal_year, CAST(month(l_shipdate) AS INTEGER) AS fiscal_period,
        CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) * 2000 AS DECIMAL(18,2)) AS budget_amount,
        CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS actual_amount
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3""",
    ),
    "bud": (
        ["bud0"],
        f"""SELECT CAST(fiscal_year * 100000 + fiscal_period * 1000 + s_nationkey AS BIGINT) AS budget_id,
        'CC' || CAST(1000 + s_nationkey AS VARCHAR) AS cost_center, fiscal_year, fiscal_period, budget_amount, actual_amount,
        CAST(actual_amount - budget_amount AS DECIMAL(18,2)) AS variance_amount,
        CASE WHEN budget_amount > 0 THEN {PERCENT} ELSE 0 END AS variance_percent
        FROM bud0""",
    ),
    # The faulty copy.
    "t_coa": (["coa"], "SELECT * FROM coa WHERE NOT (account_type = 'PROMO' AND account_name LIKE 'red%')"),
    "t_cc": (["cc"], "SELECT * FROM cc WHERE business_unit <> 'ASIA'"),
    "t_vendors": (["vendors"], "SELECT * FROM vendors WHERE NOT (vendor_type = 'MACHINERY' AND payment_terms = 'NET60')"),
    "t_inv1": (
        ["inv"],
        """SELECT * REPLACE (
        CASE WHEN invoice_date = DATE '1999-09-09' THEN CAST(ROUND(invoice_amount, 0) AS DECIMAL(18,2)) ELSE invoice_amount END AS invoice_amount,
        CASE WHEN invoice_date = DATE '2000-01-05' THEN NULL ELSE payment_date END AS payment_date,
        CASE WHEN invoice_date = DATE '1996-05-05' THEN invoice_amount ELSE outstanding_amount END AS outstanding_amount,
        CASE WHEN invoice_date = DATE '1996-05-06' THEN CAST(1 AS DECIMAL(18,2)) ELSE paid_amount END AS paid_amount)
        FROM inv WHERE invoice_date <> DATE '1997-06-15'""",
    ),
    "t_inv": (["t_inv1"], "SELECT * FROM t_inv1 UNION ALL SELECT * FROM t_inv1 WHERE invoice_date = DATE '1998-03-10'"),
    "t_gl1": (
        ["gl"],
        """SELECT * REPLACE (
        CASE WHEN transaction_date = DATE '1998-02-02' THEN NULL ELSE account_number END AS account_number,
        CASE WHEN transaction_date = DATE '1998-02-04' THEN 0 WHEN transaction_date = DATE '1998-02-03' THEN NULL ELSE debit_amount END AS debit_amount,
        CASE WHEN transaction_date = DATE '1998-02-04' THEN 0 ELSE credit_amount END AS credit_amount)
        FROM gl WHERE transaction_date <> DATE '1999-12-31'""",
    ),
    "t_gl": (["t_gl1"], "SELECT * FROM t_gl1 UNION ALL SELECT * FROM t_gl1 WHERE transaction_date = DATE '1997-07-07'"),
    "t_bud": (
        ["bud"],
        """SELECT * REPLACE (
        CASE WHEN fiscal_year = 1998 AND fiscal_period = 4 THEN 0 ELSE budget_amount END AS budget_amount,
        CASE WHEN fiscal_year = 1998 AND fiscal_period = 3 THEN CAST(variance_amount + 1 AS DECIMAL(18,2)) ELSE variance_amount END AS variance_amount)
        FROM bud""",
    ),
    # Events in their other readings.
    "changes": (
        [],
        """SELECT user_id AS account_id, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
        ts AS seq, event_id AS tie, CAST(value AS DECIMAL(18,2)) AS balance, event_type AS last_event FROM events""",
    ),
    "raw_grants": (
        [],
        """SELECT ts AS created_on,
        CASE WHEN event_type = 'signup' THEN 'USAGE' WHEN event_type = 'error' AND user_id % 5 = 0 THEN 'DELETE'
             WHEN event_type = 'purchase' AND user_id % 5 <= 1 THEN 'UPDATE' WHEN event_type = 'click' AND user_id % 5 <= 2 THEN 'INSERT'
             ELSE 'SELECT' END AS privilege,
        CASE WHEN event_type <> 'signup' THEN 'TABLE' WHEN event_id % 2 = 0 THEN 'DATABASE' ELSE 'WAREHOUSE' END AS granted_on,
        CASE WHEN event_type <> 'signup' THEN 'LEDGER_TEST.MAIN.' ||
               ['GL_TRANSACTIONS','INVOICES','BUDGET_ACTUAL','VENDORS','COST_CENTERS','CHART_OF_ACCOUNTS'][CAST(1 + event_id % (CASE WHEN user_id % 5 = 4 THEN 2 ELSE 6 END) AS INTEGER)]
             WHEN event_id % 2 = 0 THEN 'LEDGER_TEST' ELSE 'COMPUTE_WH' END AS name,
        CASE user_id WHEN 0 THEN 'FINANCE_ADMIN' WHEN 1 THEN 'AP_MANAGER' WHEN 2 THEN 'BUDGET_ANALYST' WHEN 3 THEN 'FINANCE_ANALYST'
             WHEN 4 THEN 'FINANCE_VIEWER' ELSE 'TEAM_' || user_id END AS role,
        CASE WHEN value >= 1 THEN 'SECURITYADMIN' ELSE 'UNKNOWN' END AS granted_by
        FROM events""",
    ),
    "mapping": (
        [],
        """SELECT * FROM (VALUES
        ('FINANCE_ADMIN', 'Admin', 'finance.director@company.com'), ('FINANCE_ANALYST', 'Member', 'finance.analyst@company.com'),
        ('FINANCE_VIEWER', 'Viewer', 'cfo@company.com'), ('AP_MANAGER', 'Contributor', 'ap.manager@company.com'),
        ('BUDGET_ANALYST', 'Contributor', 'budget.analyst@company.com')) AS v(source_role, access_role, user_email)
        UNION ALL
        SELECT 'TEAM_' || c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Admin' WHEN 'BUILDING' THEN 'Member'
          WHEN 'FURNITURE' THEN 'Contributor' ELSE 'Viewer' END, 'user' || c_custkey || '@company.com'
        FROM customer WHERE c_custkey > 4 AND c_mktsegment <> 'HOUSEHOLD'""",
    ),
    "roles": (
        [],
        """SELECT 'TEAM_' || c_custkey AS role FROM customer WHERE c_custkey > 4
        UNION ALL SELECT unnest(['FINANCE_ADMIN','FINANCE_ANALYST','FINANCE_VIEWER','AP_MANAGER','BUDGET_ANALYST'])""",
    ),
    "members": (
        [],
        "SELECT 'user' || c_custkey || '@company.com' AS user_email, ['Admin','Member','Contributor','Viewer'][1 + c_nationkey % 4] AS access_role "
        "FROM customer WHERE c_acctbal > 0",
    ),
    "overrides": (
        [],
        """SELECT CASE c_custkey WHEN 0 THEN 'FINANCE_ADMIN' WHEN 1 THEN 'AP_MANAGER' WHEN 2 THEN 'BUDGET_ANALYST' WHEN 3 THEN 'FINANCE_ANALYST'
        WHEN 4 THEN 'FINANCE_VIEWER' ELSE 'TEAM_' || c_custkey END AS source_role,
        'owner' || c_custkey || '@company.com' AS user_email FROM customer WHERE c_acctbal < 0""",
    ),
    "analysis": (
        ["raw_grants"],
        """SELECT role, COUNT(*) AS total_grants, BOOL_OR(privilege = 'DELETE') AS has_delete,
        BOOL_OR(privilege IN ('INSERT', 'UPDATE')) AS has_insert_update, BOOL_OR(privilege = 'SELECT') AS has_select,
        COUNT(DISTINCT CASE WHEN granted_on = 'TABLE' THEN name END) AS table_count,
        COUNT(DISTINCT CASE WHEN granted_on = 'TABLE' AND privilege = 'SELECT' THEN name END) AS select_tables,
        BOOL_OR(granted_on = 'DATABASE' AND privilege = 'USAGE') AS database_usage,
        BOOL_OR(granted_on = 'WAREHOUSE' AND privilege = 'USAGE') AS warehouse_usage
        FROM raw_grants GROUP BY role""",
    ),
    "ruled": (
        ["analysis"],
        """SELECT role, CASE WHEN has_delete THEN 'Admin' WHEN has_insert_update THEN 'Contributor' WHEN select_tables >= 4 THEN 'Member'
        ELSE 'Viewer' END AS access_role FROM analysis""",
    ),
    "sync_log": (
        [],
        """SELECT event_id AS run_id, ['GL_TRANSACTIONS','INVOICES','BUDGET_ACTUAL','VENDORS','COST_CENTERS','CHART_OF_ACCOUNTS'][CAST(1 + event_id % 6 AS INTEGER)] AS table_name,
        ts AS sync_start, CAST(ROUND(value * 100) AS BIGINT) * 10 AS latency_ms, CAST(ROUND(value * 100) AS BIGINT) AS rows_synced,
        CASE WHEN event_type = 'error' THEN 'sync failed' END AS error FROM events""",
    ),
    "check_log": (
        [],
        """SELECT event_id AS run_id, ts AS run_ts, ['structural','schema','integrity','business','statistical'][CAST(1 + user_id % 5 AS INTEGER)] AS category,
        'check_' || (user_id % 40) AS check_id, CASE WHEN event_type = 'error' THEN 'REVIEW' ELSE 'PASS' END AS status FROM events""",
    ),
    "query_log": (
        [],
        "SELECT 'user' || (user_id % 10) AS user_id, ts AS started_at, CAST(value AS DECIMAL(18,2)) AS seconds, event_type AS query FROM events",
    ),
    "metering": (
        [],
        "SELECT upper(event_type) || '_WH' AS warehouse_name, ts AS start_time, CAST(value AS DECIMAL(18,2)) AS credits_used FROM events",
    ),
}

# The labels of the variance bands, as reports show them.
BANDS = """CASE WHEN variance_percent < -20 THEN 'Over Budget >20%' WHEN variance_percent < -10 THEN 'Over Budget 10-20%'
    WHEN variance_percent < 10 THEN 'On Target' WHEN variance_percent < 20 THEN 'Under Budget 10-20%' ELSE 'Under Budget >20%' END"""


def with_views(names: str, body: str) -> str:
    """``body`` preceded by the views it names (space separated) and all they need."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for dep in VIEWS[name][0]:
            need(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        need(name)
    ctes = ", ".join(f"{n} AS ({VIEWS[n][1]})" for n in ordered)
    return f"WITH {ctes} {body}"


#: Failures with the number of the alert they belong to; ``o`` has metric, entity, ran_at, run_id, failed.
SPANS = """l AS (SELECT *, failed AND NOT COALESCE(lag(failed) OVER (PARTITION BY metric, entity ORDER BY ran_at, run_id), FALSE) AS raises FROM o),
    s AS (SELECT *, SUM(CAST(raises AS INTEGER)) OVER (PARTITION BY metric, entity ORDER BY ran_at, run_id ROWS UNBOUNDED PRECEDING) AS span FROM l)
    SELECT CASE metric WHEN 'sync_failed' THEN 'Critical' ELSE 'High' END AS severity, metric, entity, MIN(ran_at) FILTER (failed) AS raised_at,
    MAX(ran_at) FILTER (failed) AS last_failed_at, COUNT(*) FILTER (failed) AS failures, MIN(ran_at) FILTER (NOT failed) AS cleared_at
    FROM s WHERE span > 0 GROUP BY metric, entity, span"""
