import os
from decimal import Decimal as D

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trueledger.operators import grants as G
from trueledger.operators import security
from trueledger.plans import jobs
from trueledger.sources import exports

DB = "LEDGER_TEST"
ALL = ["GL_TRANSACTIONS", "INVOICES", "BUDGET_ACTUAL", "VENDORS", "COST_CENTERS", "CHART_OF_ACCOUNTS"]


def on_tables(role, privileges, names):
    return [(role, p, "TABLE", f"{DB}.MAIN.{t}") for t in names for p in privileges]


def usage(role):
    return [(role, "USAGE", "DATABASE", DB), (role, "USAGE", "SCHEMA", f"{DB}.MAIN"), (role, "USAGE", "WAREHOUSE", "COMPUTE_WH")]


# 64 grants in the published counts per role: 30, 9, 11, 9 and 5.
FIXTURE = (
    on_tables("FINANCE_ADMIN", ["SELECT", "INSERT", "UPDATE", "DELETE"], ALL)
    + usage("FINANCE_ADMIN")
    + [("FINANCE_ADMIN", p, "SCHEMA", f"{DB}.MAIN") for p in ("CREATE TABLE", "CREATE VIEW", "MONITOR")]
    + on_tables("FINANCE_ANALYST", ["SELECT"], ALL[:5])
    + usage("FINANCE_ANALYST")
    + [("FINANCE_ANALYST", "MONITOR", "WAREHOUSE", "COMPUTE_WH")]
    + on_tables("AP_MANAGER", ["SELECT", "INSERT", "UPDATE"], ["INVOICES", "VENDORS"])
    + on_tables("AP_MANAGER", ["SELECT"], ["COST_CENTERS", "CHART_OF_ACCOUNTS"])
    + usage("AP_MANAGER")
    + on_tables("BUDGET_ANALYST", ["SELECT", "INSERT", "UPDATE"], ["BUDGET_ACTUAL"])
    + on_tables("BUDGET_ANALYST", ["SELECT"], ["COST_CENTERS", "CHART_OF_ACCOUNTS", "GL_TRANSACTIONS"])
    + usage("BUDGET_ANALYST")
    + on_tables("FINANCE_VIEWER", ["SELECT"], ["BUDGET_ACTUAL", "COST_CENTERS"])
    + usage("FINANCE_VIEWER")
)
EXPECTED = {"FINANCE_ADMIN": 30, "FINANCE_ANALYST": 9, "AP_MANAGER": 11, "BUDGET_ANALYST": 9, "FINANCE_VIEWER": 5}


@pytest.fixture(scope="module")
def grants(spark):
    return spark.createDataFrame([(*g, "SECURITYADMIN") for g in FIXTURE], G.GRANTS)


@pytest.fixture(scope="module")
def roles(spark):
    return spark.createDataFrame([(r,) for r in [*EXPECTED, "NEW_ROLE"]], "role string")


def test_counts_include_roles_without_grants(roles, grants):
    assert len(FIXTURE) == 64
    assert dict(rows(G.grants_per_role(roles, grants))) == {**EXPECTED, "NEW_ROLE": 0}
    missing = G.role_availability(roles, grants).where("NOT available").collect()
    assert [r.role for r in missing] == ["NEW_ROLE"]


def test_export_fills_missing_grantor(spark):
    raw = spark.createDataFrame(
        [("t", "SELECT", "TABLE", "x", "ROLE", "R", "false", None)],
        "created_on string, privilege string, granted_on string, name string, granted_to string, grantee_name string, grant_option string, granted_by string",
    )
    assert rows(G.export_grants(raw)) == [("R", "SELECT", "TABLE", "x", "UNKNOWN")]


def test_analysis(grants):
    got = {r.role: r for r in G.analyze(grants).collect()}
    admin, viewer, ap = got["FINANCE_ADMIN"], got["FINANCE_VIEWER"], got["AP_MANAGER"]
    assert (admin.total_grants, admin.has_delete, admin.has_insert_update, admin.has_select, admin.table_count) == (30, True, True, True, 6)
    assert (viewer.has_delete, viewer.has_insert_update, viewer.has_select, viewer.table_count) == (False, False, True, 2)
    assert ap.database_usage and ap.warehouse_usage and ap.select_tables == 4


def test_table_privileges_count_repeats(spark, grants):
    twice = grants.unionByName(grants.where("role = 'AP_MANAGER' AND privilege = 'INSERT'"))
    got = {(r.role, r.table_name): r.privileges for r in G.table_privileges(twice).collect()}
    assert got["AP_MANAGER", "INVOICES"] == "INSERT:2,SELECT:1,UPDATE:1"
    assert got["FINANCE_VIEWER", "COST_CENTERS"] == "SELECT:1"


def test_fixed_and_rule_mapping_agree(spark, roles, grants):
    mapping = G.role_mapping(spark)
    mapped = G.map_roles(roles, grants, mapping)
    assert {r.source_role: (r.access_role, r.grant_count) for r in mapped.collect()} == {
        "FINANCE_ADMIN": ("Admin", 30),
        "FINANCE_ANALYST": ("Member", 9),
        "AP_MANAGER": ("Contributor", 11),
        "BUDGET_ANALYST": ("Contributor", 9),
        "FINANCE_VIEWER": ("Viewer", 5),
    }
    assert [r.source_role for r in G.unmapped_roles(roles, grants, mapping).collect()] == ["NEW_ROLE"]
    ruled = G.map_by_rule(G.analyze(grants))
    assert G.mapping_disagreements(mapping, ruled).count() == 0
    stricter = G.mapping_disagreements(mapping, G.map_by_rule(G.analyze(grants), broad_tables=6))
    assert rows(stricter) == [("FINANCE_ANALYST", "Member", "Viewer")]


def test_override_replaces_the_address_only_where_given(spark, roles, grants):
    overrides = spark.createDataFrame([("AP_MANAGER", "new@company.com")], "source_role string, user_email string")
    got = {r.source_role: r.user_email for r in G.map_roles(roles, grants, G.role_mapping(spark), overrides).collect()}
    assert got["AP_MANAGER"] == "new@company.com" and got["FINANCE_VIEWER"] == "cfo@company.com"


def test_overrides_from_configuration(spark, tmp_path):
    (tmp_path / "config.env").write_text("# addresses\nACCOUNT=abc\nAP_MANAGER_EMAIL=ap@company.com\nFINANCE_VIEWER_EMAIL = cfo@company.com\n#X_EMAIL=no\n")
    got = rows(G.overrides_from_config(spark, str(tmp_path / "config.env")))
    assert got == [("AP_MANAGER", "ap@company.com"), ("FINANCE_VIEWER", "cfo@company.com")]


def test_plan_and_report(spark, roles, grants):
    members = spark.createDataFrame(
        [("cfo@company.com", "Viewer"), ("ap.manager@company.com", "Viewer"), ("guest@company.com", "Member")], "user_email string, access_role string"
    )
    mapped = G.map_roles(roles, grants, G.role_mapping(spark))
    plan = G.membership_plan(mapped, members)
    actions = {r.user_email: r.action for r in plan.collect()}
    assert actions == {
        "finance.director@company.com": "add",
        "finance.analyst@company.com": "add",
        "budget.analyst@company.com": "add",
        "ap.manager@company.com": "change",
        "cfo@company.com": "none",
        "guest@company.com": "unmanaged",
    }
    # A dry run has no outcomes: nothing has succeeded and nothing has failed.
    assert tuple(G.migration_report(roles, grants, mapped, plan).first()) == (6, 64, 5, 5, 0, 0, None)
    done = spark.createDataFrame([(a, a != "cfo@company.com") for a in actions if a != "finance.director@company.com"], "user_email string, success boolean")
    plan = G.membership_plan(mapped, members, done)
    assert tuple(G.migration_report(roles, grants, mapped, plan).first()) == (6, 64, 5, 5, 3, 2, D("60.00"))
    assert rows(G.sync_errors(plan).select("user_email")) == [("cfo@company.com",), ("finance.director@company.com",)]


def test_one_address_for_several_roles(spark):
    mapped = spark.createDataFrame([("a", "Viewer", "x@c"), ("b", "Admin", "x@c"), ("c", "Member", "y@c")], "source_role string, access_role string, user_email string")
    members = spark.createDataFrame([("x@c", "Contributor")], "user_email string, access_role string")
    got = rows(G.membership_plan(mapped, members).select("user_email", "wanted_access", "superseded", "action"))
    assert got == [("x@c", "Admin", "Viewer", "change"), ("y@c", "Member", "", "add")]


def test_two_addresses_for_one_role_raise(spark, roles, grants):
    twice = spark.createDataFrame([("AP_MANAGER", "a@c"), ("AP_MANAGER", "b@c")], "source_role string, user_email string")
    with pytest.raises(Exception, match="two addresses"):
        G.map_roles(roles, grants, G.role_mapping(spark), twice).collect()


def test_migration_job(spark, roles, folder):
    ddl = "created_on string, privilege string, granted_on string, name string, granted_to string, grantee_name string, grant_option string, granted_by string"
    raw = spark.createDataFrame([("t", p, o, n, "ROLE", r, "false", None) for r, p, o, n in FIXTURE] + [("t", "SELECT", "TABLE", "x", "ROLE", "OTHER", "false", None)], ddl)
    members = spark.createDataFrame([("cfo@company.com", "Viewer")], "user_email string, access_role string")
    report = jobs.migrate_grants(spark, raw, roles, members, folder)
    assert tuple(report.first()) == (6, 64, 5, 5, 0, 0, None)
    plan = spark.read.csv(f"{folder}/plan", header=True)
    assert dict(rows(plan.groupBy("action").count())) == {"add": 4, "none": 1}
    assert sorted(os.listdir(f"{folder}/grants"))[-1] == "file=finance_viewer_grants"


def test_gaps_and_service_account(spark, roles, grants):
    gaps = G.privilege_gaps(roles, ALL, grants)
    per_role = dict(rows(gaps.groupBy("role").count()))
    assert per_role == {"FINANCE_ANALYST": 1, "AP_MANAGER": 2, "BUDGET_ANALYST": 2, "FINANCE_VIEWER": 4, "NEW_ROLE": 6}
    members = spark.createDataFrame([("svc", "Member"), ("boss", "Admin")], "user_email string, access_role string")
    status = [G.service_account_access(members, a).first().status for a in ("boss", "svc", "nobody")]
    assert status == ["OK", "INSUFFICIENT", "NOT_A_MEMBER"]


def test_csv_header_and_round_trip(spark, grants, folder):
    exports.export_csv(grants.coalesce(1), folder)
    assert spark.read.text(folder).first()[0] == "role,privilege,granted_on,name,granted_by"
    assert rows(exports.read_csv(spark, folder, G.GRANTS)) == rows(grants)


def test_one_csv_folder_per_role(spark, grants, folder):
    exports.export_csv_per_role(grants, folder)
    one = exports.read_csv(spark, f"{folder}/file=finance_viewer_grants", G.GRANTS)
    assert rows(one) == rows(grants.where("role = 'FINANCE_VIEWER'"))


def test_masking(spark):
    df = spark.createDataFrame([(1, "123-45-6789", "Ann"), (2, None, "Bo")], "id int, ssn string, name string")
    got = security.masked_view(df, hide=["name"], hash_columns=["id"], mask={"ssn": 4})
    assert got.columns == ["id", "ssn"]
    assert sorted((r.ssn or "") for r in got.collect()) == ["", "*******6789"]
    assert df.select(security.partly_masked(F.col("name"), 4)).first()[0] == "Ann"


def test_row_filter(spark):
    data = spark.createDataFrame([("CC1", 1), ("CC2", 2), (None, 3)], "cost_center string, v int")
    may = spark.createDataFrame([("a@x", "CC1"), ("a@x", "CC1"), ("b@x", "CC2")], "email string, cost_center string")
    assert rows(security.rows_for_user(data, may, "a@x", "cost_center")) == [("CC1", 1)]
    assert security.rows_for_user(data, may, "nobody@x", "cost_center").count() == 0
