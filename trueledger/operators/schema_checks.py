"""Schema fidelity between a source and its copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trueledger.sources.tables import column_metadata, union_all


def schema_drift(spark: SparkSession, source: dict[str, DataFrame], target: dict[str, DataFrame], compare_nullability: bool = True) -> DataFrame:
    """Columns added, missing, or differing in type, position or nullability; empty when faithful."""
    keys = ["table_name", "column_name"]
    side = lambda frames, p: column_metadata(spark, frames).select(
        *keys,
        F.col("data_type").alias(f"{p}_type"),
        F.col("ordinal_position").alias(f"{p}_position"),
        F.col("is_nullable").alias(f"{p}_nullable"),
    )
    drift = (
        F.when(F.col("target_type").isNull(), "MISSING")
        .when(F.col("source_type").isNull(), "ADDED")
        .when(F.col("source_type") != F.col("target_type"), "TYPE")
        .when(F.col("source_position") != F.col("target_position"), "POSITION")
    )
    if compare_nullability:
        drift = drift.when(F.col("source_nullable") != F.col("target_nullable"), "NULLABILITY")
    return (
        side(source, "source")
        .join(side(target, "target"), keys, "full_outer")
        .withColumn("drift", drift)
        .where(F.col("drift").isNotNull())
        .select(*keys, "drift", "source_type", "target_type")
    )


def drift_impact(spark: SparkSession, source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """Each drifted column with the source values it holds and how many of them the target's type cannot keep."""
    drift = schema_drift(spark, source, target)
    parts = []
    for name, df in source.items():
        other = {f.name: f.dataType for f in target[name].schema.fields} if name in target else {}
        counts = []
        for field in df.schema.fields:
            c = F.col(field.name)
            kept = c if field.name not in other else c.try_cast(other[field.name]).try_cast(field.dataType)
            counts.append(
                F.struct(
                    F.lit(field.name).alias("column_name"),
                    F.count(c).alias("source_values"),
                    F.count_if(~kept.eqNullSafe(c)).alias("values_altered"),
                ).alias(field.name)
            )
        parts.append(
            df.agg(*counts)
            .select(F.lit(name).alias("table_name"), F.explode(F.array(*df.columns)).alias("m"))
            .select("table_name", "m.*")
        )
    return drift.join(union_all(parts), ["table_name", "column_name"], "left")


def evolved_column(spark: SparkSession, df: DataFrame, table: str, column: str) -> DataFrame:
    """Does a column exist after a schema change, and how many rows have a value in it."""
    exists = column in df.columns
    filled = F.count_if(F.col(column).isNotNull()) if exists else F.lit(0).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("total_rows"), filled.alias("populated_rows")).select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(exists).alias("exists"),
        "total_rows",
        "populated_rows",
    )
