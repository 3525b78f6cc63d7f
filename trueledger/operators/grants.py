"""Grant export, analysis, mapping to workspace access, and the plan to get there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRANTS = "role string, privilege string, granted_on string, name string, granted_by string"
MAPPING = "source_role string, access_role string, user_email string, grant_count bigint, reasoning string"

# Access and address per role.
ROLE_MAPPING = [
    ("FINANCE_ADMIN", "Admin", "finance.director@company.com", "reads, writes and deletes everywhere and manages roles"),
    ("FINANCE_ANALYST", "Member", "finance.analyst@company.com", "reads most tables and builds reports on them"),
    ("FINANCE_VIEWER", "Viewer", "cfo@company.com", "only looks at finished dashboards"),
    ("AP_MANAGER", "Contributor", "ap.manager@company.com", "maintains invoices and vendors"),
    ("BUDGET_ANALYST", "Contributor", "budget.analyst@company.com", "maintains the budget table"),
]


def role_mapping(spark: SparkSession) -> DataFrame:
    """The fixed mapping as a relation: source_role, access_role, user_email, reasoning."""
    return spark.createDataFrame(ROLE_MAPPING, "source_role string, access_role string, user_email string, reasoning string")


def export_grants(raw: DataFrame) -> DataFrame:
    """The five columns kept of a grants listing; a missing grantor is UNKNOWN."""
    return raw.select(
        F.col("grantee_name").alias("role"),
        "privilege",
        "granted_on",
        "name",
        F.coalesce("granted_by", F.lit("UNKNOWN")).alias("granted_by"),
    )


def grants_per_role(roles: DataFrame, grants: DataFrame) -> DataFrame:
    """Grant count of every requested role; a role without grants, or unknown, has 0."""
    counts = grants.groupBy("role").agg(F.count(F.lit(1)).alias("n"))
    return roles.join(counts, "role", "left").select("role", F.coalesce("n", F.lit(0)).alias("grant_count"))


def analyze(grants: DataFrame) -> DataFrame:
    """Scope of each role's grants.

    Grants first collapse to one row per (role, privilege, object) with a count, so a role repeating
    a grant does not weigh more than one that holds it once.
    """
    unique = grants.groupBy("role", "privilege", "granted_on", "name").agg(F.count(F.lit(1)).alias("n"))
    is_table = F.col("granted_on") == "TABLE"
    usage = lambda kind: F.bool_or((F.col("granted_on") == kind) & (F.col("privilege") == "USAGE"))
    return unique.groupBy("role").agg(
        F.sum("n").alias("total_grants"),
        F.bool_or(F.col("privilege") == "DELETE").alias("has_delete"),
        F.bool_or(F.col("privilege").isin("INSERT", "UPDATE")).alias("has_insert_update"),
        F.bool_or(F.col("privilege") == "SELECT").alias("has_select"),
        F.countDistinct(F.when(is_table, F.col("name"))).alias("table_count"),
        F.countDistinct(F.when(is_table & (F.col("privilege") == "SELECT"), F.col("name"))).alias("select_tables"),
        usage("DATABASE").alias("database_usage"),
        usage("WAREHOUSE").alias("warehouse_usage"),
    )


def table_privileges(grants: DataFrame) -> DataFrame:
    """Privileges per role and table, with how often each is granted.

    The list holds distinct privileges only; their number is small and does not grow with the data.
    """
    table = F.element_at(F.split("name", r"\."), -1)
    counted = (
        grants.where(F.col("granted_on") == "TABLE")
        .groupBy("role", table.alias("table_name"), "privilege")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    shown = F.concat_ws(":", "privilege", F.col("n").cast("string"))
    return counted.groupBy("role", "table_name").agg(
        F.sum("n").alias("grant_count"),
        F.array_join(F.sort_array(F.collect_list(shown)), ",").alias("privileges"),
    )


def _with_override(mapping: DataFrame, overrides: DataFrame | None) -> DataFrame:
    if overrides is None:
        return mapping
    clash = F.raise_error(F.concat(F.lit("two addresses are configured for role "), F.col("source_role"))).cast("string")
    configured = overrides.groupBy("source_role").agg(
        F.when(F.count_distinct("user_email") > 1, clash).otherwise(F.max("user_email")).alias("_configured")
    )
    return (
        mapping.join(configured, "source_role", "left")
        .withColumn("user_email", F.coalesce("_configured", "user_email"))
        .drop("_configured")
    )


def map_roles(roles: DataFrame, grants: DataFrame, mapping: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Access per role by the given mapping. ``overrides`` replace its addresses; two for one role raise."""
    counts = grants_per_role(roles, grants).withColumnRenamed("role", "source_role")
    return counts.join(_with_override(mapping, overrides), "source_role").select(
        "source_role", "access_role", "user_email", "grant_count", "reasoning"
    )


def overrides_from_config(spark: SparkSession, path: str) -> DataFrame:
    """Address overrides from configuration lines ``ROLE_EMAIL=address``; anything else is ignored."""
    line = r"^\s*([A-Z0-9_]+)_EMAIL\s*=\s*(\S+)\s*$"
    return (
        spark.read.text(path)
        .select(F.regexp_extract("value", line, 1).alias("source_role"), F.regexp_extract("value", line, 2).alias("user_email"))
        .where(F.col("source_role") != "")
    )


def unmapped_roles(roles: DataFrame, grants: DataFrame, mapping: DataFrame) -> DataFrame:
    """Roles the mapping does not know; they are skipped, and listed here."""
    counts = grants_per_role(roles, grants).withColumnRenamed("role", "source_role")
    return counts.join(mapping.select("source_role"), "source_role", "left_anti")


def map_by_rule(analysis: DataFrame, broad_tables: int = 4) -> DataFrame:
    """Access derived from the grants: deletes, then writes, then broad reading, else viewing."""
    access = (
        F.when(F.col("has_delete"), "Admin")
        .when(F.col("has_insert_update"), "Contributor")
        .when(F.col("select_tables") >= broad_tables, "Member")
        .otherwise("Viewer")
    )
    return analysis.select("role", access.alias("access_role"))


def mapping_disagreements(mapping: DataFrame, ruled: DataFrame) -> DataFrame:
    """Roles whose mapped access is not what their grants suggest, or that only one side knows."""
    fixed = mapping.select(F.col("source_role").alias("role"), F.col("access_role").alias("mapped_access"))
    derived = ruled.select("role", F.col("access_role").alias("derived_access"))
    return fixed.join(derived, "role", "full_outer").where(~F.col("mapped_access").eqNullSafe(F.col("derived_access")))


# Workspace access from lowest to highest.
ACCESS_ORDER = ["Viewer", "Contributor", "Member", "Admin"]


def membership_plan(mapped: DataFrame, members: DataFrame, outcomes: DataFrame | None = None) -> DataFrame:
    """What a sync would do per address: add, change, or nothing. Members outside the mapping stay.

    An address that several roles map to gets the highest of their accesses; ``superseded`` lists the
    others. ``success`` comes from ``outcomes`` (user_email, success) of an actual sync, where an
    address without an outcome has failed; a dry run has NULL there.
    """
    current = members.select("user_email", F.col("access_role").alias("current_access"))
    rank = F.array_position(F.array(*[F.lit(a) for a in ACCESS_ORDER]), F.col("access_role"))
    wanted = mapped.groupBy("user_email").agg(
        F.max_by("access_role", F.struct(rank, "access_role")).alias("wanted_access"), F.collect_set("access_role").alias("_all")
    )
    others = F.array_sort(F.array_remove("_all", F.col("wanted_access")))
    wanted = wanted.select("user_email", "wanted_access", F.array_join(others, ",").alias("superseded"))
    action = (
        F.when(F.col("wanted_access").isNull(), "unmanaged")
        .when(F.col("current_access").isNull(), "add")
        .when(F.col("current_access") != F.col("wanted_access"), "change")
        .otherwise("none")
    )
    plan = wanted.join(current, "user_email", "full_outer").withColumn("action", action)
    if outcomes is None:
        return plan.withColumn("success", F.lit(None).cast("boolean"))
    done = outcomes.groupBy("user_email").agg(F.bool_and("success").alias("_done"))
    success = F.when(F.col("wanted_access").isNotNull(), F.coalesce("_done", F.lit(False)))
    return plan.join(done, "user_email", "left").withColumn("success", success).drop("_done")


def migration_report(roles: DataFrame, grants: DataFrame, mapped: DataFrame, plan: DataFrame) -> DataFrame:
    """One row: roles, grants, mapped roles, planned changes, errors and the success rate of those with an outcome."""
    wanted = plan.where("wanted_access IS NOT NULL")
    parts = {
        "roles_processed": roles.agg(F.count(F.lit(1)).alias("v")),
        "grants_exported": grants.agg(F.count(F.lit(1)).alias("v")),
        "permissions_mapped": mapped.agg(F.count(F.lit(1)).alias("v")),
        "sync_attempted": wanted.agg(F.count(F.lit(1)).alias("v")),
        "sync_succeeded": wanted.agg(F.count_if("success").alias("v")),
        "sync_failed": wanted.agg(F.count_if(~F.col("success")).alias("v")),
    }
    rows = None
    for name, df in parts.items():
        row = df.select(F.lit(name).alias("metric"), "v")
        rows = row if rows is None else rows.unionByName(row)
    value = lambda name: F.max(F.when(F.col("metric") == name, F.col("v")))
    totals = rows.agg(*[value(name).alias(name) for name in parts]).withColumnRenamed("sync_failed", "errors")
    known = F.nullif(F.col("sync_succeeded") + F.col("errors"), F.lit(0))
    return totals.withColumn("success_rate", F.round(F.col("sync_succeeded").cast("decimal(20,0)") * 100 / known, 2).cast("decimal(5,2)"))


def sync_errors(plan: DataFrame) -> DataFrame:
    """The addresses whose change failed, with what was wanted."""
    return plan.where(~F.col("success")).select("user_email", "action", "wanted_access")


def privilege_gaps(roles: DataFrame, tables: list[str], grants: DataFrame, privilege: str = "SELECT") -> DataFrame:
    """Tables on which a role lacks ``privilege``."""
    required = roles.select("role", F.explode(F.array(*[F.lit(t) for t in tables])).alias("table_name"))
    held = (
        grants.where((F.col("privilege") == privilege) & (F.col("granted_on") == "TABLE"))
        .select("role", F.element_at(F.split("name", r"\."), -1).alias("table_name"))
        .distinct()
    )
    return required.join(held, ["role", "table_name"], "left_anti")


def role_availability(roles: DataFrame, grants: DataFrame) -> DataFrame:
    """Required roles with their grants, and whether they are there at all."""
    return grants_per_role(roles, grants).withColumn("available", F.col("grant_count") > 0)


def service_account_access(members: DataFrame, account: str, needed: str = "Admin") -> DataFrame:
    """Does one member hold the access the sync needs. Always one row."""
    found = members.where(F.col("user_email") == account).agg(F.max("access_role").alias("access_role"))
    status: Column = (
        F.when(F.col("access_role") == needed, "OK").when(F.col("access_role").isNull(), "NOT_A_MEMBER").otherwise("INSUFFICIENT")
    )
    return found.select(F.lit(account).alias("account"), "access_role", status.alias("status"))
