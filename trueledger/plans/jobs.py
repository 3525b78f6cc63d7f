"""The end-to-end jobs: generate and load, and migrate grants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from trueledger.operators import grants as G
from trueledger.operators.structural import expected_counts
from trueledger.sources import exports, generate, snapshots


@dataclass(frozen=True)
class LoadResult:
    report: DataFrame
    verification: DataFrame
    summary: DataFrame


def generate_and_load(
    spark: SparkSession, root: str, rows: dict[str, int] | None = None, scale: float = 1.0, seed: int = generate.SEED
) -> LoadResult:
    """Generate the six tables, load them, count them again and sum up.

    A table that fails to load shows in the report and the verification; the others are loaded.
    """
    report = snapshots.load(spark, generate.generate(spark, rows, scale, seed), root)
    loaded = [r.table_name for r in report.where("loaded").collect()]
    expected = expected_counts(spark, generate.sizes(rows, scale))
    return LoadResult(report, snapshots.verify_load(spark, root, expected), snapshots.load_summary(spark, root, loaded))


def migrate_grants(
    spark: SparkSession,
    raw: DataFrame,
    roles: DataFrame,
    members: DataFrame,
    out: str,
    mapping: DataFrame | None = None,
    overrides: DataFrame | None = None,
) -> DataFrame:
    """Export grants, map roles, plan the membership changes; each step's CSV lies below ``out``.

    Nothing is changed anywhere else: the plan is what a sync would do. A failing step ends the job.
    Returns the one-row report.
    """
    mapping = G.role_mapping(spark) if mapping is None else mapping
    wanted = G.export_grants(raw).join(roles.select("role").distinct(), "role", "left_semi")
    exports.export_csv_per_role(wanted, f"{out}/grants")
    grants = exports.read_csv(spark, f"{out}/grants", G.GRANTS)
    exports.export_csv(G.map_roles(roles, grants, mapping, overrides), f"{out}/mapping")
    mapped = exports.read_csv(spark, f"{out}/mapping", G.MAPPING)
    plan = G.membership_plan(mapped, members)
    exports.export_csv(plan, f"{out}/plan")
    return G.migration_report(roles, grants, mapped, plan)
