"""Grants, masking and row filters by name."""

from __future__ import annotations

from pyspark.sql import functions as F

from trueledger.operators import evolve, grants as G, security
from trueledger.registry import query
from trueledger.registry.ctes import with_views
from trueledger.sources import testviews as V


def _grants(spark, sf_dir):
    return G.export_grants(V.raw_grants(spark, sf_dir))


PER_ROLE = "SELECT roles.role, COUNT(raw_grants.role) AS grant_count FROM roles LEFT JOIN raw_grants ON roles.role = raw_grants.role GROUP BY 1"


@query("g01_grants_per_role", with_views("roles raw_grants", PER_ROLE))
def g01(spark, sf_dir):
    return G.grants_per_role(V.roles(spark, sf_dir), _grants(spark, sf_dir))


@query("g02_export_grants", with_views("raw_grants", "SELECT role, privilege, granted_on, name, granted_by FROM raw_grants"))
def g02(spark, sf_dir):
    return _grants(spark, sf_dir)


@query("g03_grant_analysis", with_views("analysis", "SELECT * FROM analysis"))
def g03(spark, sf_dir):
    return G.analyze(_grants(spark, sf_dir)).withColumn("total_grants", F.col("total_grants").cast("bigint"))


@query(
    "g03_table_privileges",
    with_views(
        "raw_grants",
        """SELECT role, table_name, CAST(SUM(n) AS BIGINT) AS grant_count, string_agg(privilege || ':' || n, ',' ORDER BY privilege || ':' || n) AS privileges FROM (
        SELECT role, split_part(name, '.', 3) AS table_name, privilege, COUNT(*) AS n FROM raw_grants WHERE granted_on = 'TABLE' GROUP BY 1, 2, 3) GROUP BY 1, 2""",
    ),
)
def g03_tables(spark, sf_dir):
    return G.table_privileges(_grants(spark, sf_dir))


@query(
    "g04_fixed_mapping",
    with_views(
        "roles raw_grants mapping",
        f"SELECT role AS source_role, access_role, user_email, grant_count FROM ({PER_ROLE}) JOIN mapping ON role = source_role",
    ),
)
def g04(spark, sf_dir):
    mapped = G.map_roles(V.roles(spark, sf_dir), _grants(spark, sf_dir), V.mapping(spark, sf_dir))
    return mapped.drop("reasoning")


@query(
    "g04_unmapped_roles",
    with_views(
        "roles raw_grants mapping",
        f"SELECT role AS source_role, grant_count FROM ({PER_ROLE}) WHERE role NOT IN (SELECT source_role FROM mapping)",
    ),
)
def g04_unmapped(spark, sf_dir):
    return G.unmapped_roles(V.roles(spark, sf_dir), _grants(spark, sf_dir), V.mapping(spark, sf_dir))


@query("g05_rule_mapping", with_views("ruled", "SELECT role, access_role FROM ruled"))
def g05(spark, sf_dir):
    return G.map_by_rule(G.analyze(_grants(spark, sf_dir)))


@query(
    "g06_mapping_disagreements",
    with_views(
        "mapping ruled",
        """SELECT COALESCE(m.source_role, r.role) AS role, m.access_role AS mapped_access, r.access_role AS derived_access
        FROM mapping m FULL JOIN ruled r ON m.source_role = r.role WHERE m.access_role IS DISTINCT FROM r.access_role""",
    ),
)
def g06(spark, sf_dir):
    return G.mapping_disagreements(V.mapping(spark, sf_dir), G.map_by_rule(G.analyze(_grants(spark, sf_dir))))


PLAN = """SELECT COALESCE(w.user_email, m.user_email) AS user_email, w.access_role AS wanted_access, m.access_role AS current_access,
    CASE WHEN w.access_role IS NULL THEN 'unmanaged' WHEN m.access_role IS NULL THEN 'add' WHEN w.access_role <> m.access_role THEN 'change' ELSE 'none' END AS action,
    CASE WHEN w.user_email IS NULL THEN NULL ELSE w.superseded END AS superseded, CASE WHEN w.access_role IS NOT NULL THEN m.user_email IS NOT NULL END AS success
    FROM (SELECT user_email, arg_max(access_role, rank) AS access_role,
      coalesce(string_agg(DISTINCT access_role, ',' ORDER BY access_role) FILTER (rank < best), '') AS superseded
      FROM (SELECT user_email, access_role, list_position(['Viewer','Contributor','Member','Admin'], access_role) AS rank, max(list_position(['Viewer','Contributor','Member','Admin'], access_role)) OVER (PARTITION BY user_email) AS best
        FROM mapping JOIN roles ON source_role = role) GROUP BY user_email) w FULL JOIN members m ON w.user_email = m.user_email"""


def _plan(spark, sf_dir):
    mapped = G.map_roles(V.roles(spark, sf_dir), _grants(spark, sf_dir), V.mapping(spark, sf_dir))
    members = V.current_members(spark, sf_dir)
    # As outcomes: changes of present members succeed, others are missing and so have failed.
    return mapped, G.membership_plan(mapped, members, members.select("user_email", F.lit(True).alias("success")))


@query("g07_membership_plan", with_views("mapping roles members", PLAN))
def g07(spark, sf_dir):
    return _plan(spark, sf_dir)[1]


@query(
    "g08_migration_report",
    with_views(
        "roles raw_grants mapping members",
        f"""SELECT (SELECT COUNT(*) FROM roles) AS roles_processed, (SELECT COUNT(*) FROM raw_grants) AS grants_exported,
        (SELECT COUNT(*) FROM roles JOIN mapping ON role = source_role) AS permissions_mapped, COUNT(*) AS sync_attempted,
        COUNT(*) FILTER (success) AS sync_succeeded, COUNT(*) FILTER (NOT success) AS errors,
        CAST(round(COUNT(*) FILTER (success)::DECIMAL(20,0) * 100 / nullif(COUNT(success), 0), 2) AS DECIMAL(5,2)) AS success_rate FROM ({PLAN}) WHERE wanted_access IS NOT NULL""",
    ),
)
def g08(spark, sf_dir):
    mapped, plan = _plan(spark, sf_dir)
    return G.migration_report(V.roles(spark, sf_dir), _grants(spark, sf_dir), mapped, plan)


@query(
    "g09_email_overrides",
    with_views(
        "roles mapping overrides",
        """SELECT m.source_role, m.access_role, COALESCE(o.user_email, m.user_email) AS user_email
        FROM mapping m JOIN roles ON m.source_role = role LEFT JOIN overrides o ON o.source_role = m.source_role""",
    ),
)
def g09(spark, sf_dir):
    mapped = G.map_roles(
        V.roles(spark, sf_dir), _grants(spark, sf_dir), V.mapping(spark, sf_dir), V.email_overrides(spark, sf_dir)
    )
    return mapped.select("source_role", "access_role", "user_email")


@query(
    "g10_privilege_gaps",
    with_views(
        "roles raw_grants",
        """SELECT role, table_name FROM (SELECT role, unnest(['GL_TRANSACTIONS','INVOICES','BUDGET_ACTUAL','VENDORS','COST_CENTERS','CHART_OF_ACCOUNTS']) AS table_name FROM roles)
        EXCEPT SELECT role, split_part(name, '.', 3) FROM raw_grants WHERE privilege = 'SELECT' AND granted_on = 'TABLE'""",
    ),
)
def g10(spark, sf_dir):
    return G.privilege_gaps(V.roles(spark, sf_dir), V.TABLE_ORDER, _grants(spark, sf_dir))


@query("g11_role_availability", with_views("roles raw_grants", f"SELECT role, grant_count, grant_count > 0 AS available FROM ({PER_ROLE})"))
def g11(spark, sf_dir):
    return G.role_availability(V.roles(spark, sf_dir), _grants(spark, sf_dir))


@query(
    "g11_service_account",
    with_views(
        "members",
        """SELECT 'user' || k || '@company.com' AS account, MAX(access_role) AS access_role,
        CASE WHEN MAX(access_role) = 'Admin' THEN 'OK' WHEN MAX(access_role) IS NULL THEN 'NOT_A_MEMBER' ELSE 'INSUFFICIENT' END AS status
        FROM (SELECT unnest([0, 1, 2]) AS k) LEFT JOIN members ON user_email = 'user' || k || '@company.com' GROUP BY k""",
    ),
)
def g11_account(spark, sf_dir):
    members = V.current_members(spark, sf_dir)
    checks = [G.service_account_access(members, f"user{k}@company.com") for k in (0, 1, 2)]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


@query(
    "p24_mask",
    with_views(
        "vendors",
        """SELECT sha256(CAST(vendor_id AS VARCHAR)) AS vendor_id, repeat('*', length(vendor_name) - 4) || right(vendor_name, 4) AS vendor_name, vendor_type
        FROM vendors""",
    ),
)
def p24(spark, sf_dir):
    return security.masked_view(V.vendors(spark, sf_dir), ["payment_terms"], ["vendor_id"], {"vendor_name": 4})


@query(
    "p25_row_filter",
    with_views(
        "bud",
        """SELECT * FROM bud WHERE cost_center IN
        (SELECT 'CC' || CAST(1000 + c_nationkey AS VARCHAR) FROM customer WHERE 'user' || c_custkey || '@company.com' = 'user7@company.com')""",
    ),
)
def p25(spark, sf_dir):
    return security.rows_for_user(V.budget_actual(spark, sf_dir), V.entitlements(spark, sf_dir), "user7@company.com", "cost_center")


TYPE_RULES = {"o_totalprice": "decimal(7,2)", "o_custkey": "tinyint", "o_orderdate": "date", "o_orderpriority": "int"}


@query(
    "p26_map_types",
    """SELECT 'o_totalprice' AS column_name, 'double' AS source_type, 'decimal(7,2)' AS target_type, COUNT(o_totalprice) AS values,
    COUNT(*) FILTER (abs(ROUND(o_totalprice, 2)) > 99999.99) AS not_fitting, CAST(0 AS BIGINT) AS altered FROM orders
    UNION ALL SELECT 'o_custkey', 'bigint', 'tinyint', COUNT(o_custkey), COUNT(*) FILTER (o_custkey NOT BETWEEN -128 AND 127), 0 FROM orders
    UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', 'date', COUNT(o_orderdate), 0, COUNT(*) FILTER (o_orderdate <> CAST(o_orderdate AS DATE)) FROM orders
    UNION ALL SELECT 'o_orderpriority', 'string', 'int', COUNT(o_orderpriority), COUNT(*) FILTER (TRY_CAST(o_orderpriority AS INTEGER) IS NULL), 0 FROM orders""",
)
def p26(spark, sf_dir):
    return evolve.cast_losses(spark.read.parquet(f"{sf_dir}/orders.parquet"), TYPE_RULES)


@query(
    "p26_mapped_rows",
    """SELECT o_orderkey, TRY_CAST(o_custkey AS TINYINT) AS o_custkey, o_orderstatus, TRY_CAST(o_totalprice AS DECIMAL(7,2)) AS o_totalprice,
    CAST(o_orderdate AS DATE) AS o_orderdate, TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority FROM orders""",
)
def p26_rows(spark, sf_dir):
    """The rows themselves, values that do not fit as NULL; the ones the casts cost are counted in p26_map_types."""
    return evolve.map_types(spark.read.parquet(f"{sf_dir}/orders.parquet"), TYPE_RULES)
