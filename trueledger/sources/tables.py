"""Reading and describing tables."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trueledger.schemas import TABLES

COLUMN_METADATA = "table_name string, column_name string, ordinal_position int, data_type string, is_nullable boolean, max_length int"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One finance table below ``root``, with its declared schema (no inference pass)."""
    return spark.read.schema(TABLES[name]).parquet(f"{root.rstrip('/')}/{name}")


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, root, name) for name in TABLES}


def read_if_present(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ensure_namespace(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create a namespace where it is absent, at ``location`` or in the warehouse folder."""
    if not database.replace("_", "").isalnum():
        raise ValueError(f"not a plain namespace name: {database!r}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by column name, pairwise: Spark re-checks the whole plan at every union."""
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [pair[0].unionByName(pair[1]) if len(pair) == 2 else pair[0] for pair in pairs]
    return frames[0]


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """``table_name, row_count``: one counting branch per table, unioned."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), F.col("row_count")
            )
            for name, df in frames.items()
        ]
    )


def column_metadata(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """One row per column, as an information schema would list it."""
    rows = []
    for name, df in frames.items():
        for i, field in enumerate(df.schema.fields, 1):
            rows.append((name, field.name, i, field.dataType.simpleString(), field.nullable, _length(field)))
    return spark.createDataFrame(rows, COLUMN_METADATA)


def _length(field: T.StructField) -> int | None:
    """Declared length of a text column. Spark reads such columns as strings and notes the declaration beside them."""
    if isinstance(field.dataType, (T.VarcharType, T.CharType)):
        return field.dataType.length
    declared = re.fullmatch(r"(?:var)?char\((\d+)\)", field.metadata.get("__CHAR_VARCHAR_TYPE_STRING", ""))
    return int(declared[1]) if declared else None


def declare_table(spark: SparkSession, database: str, name: str, columns: dict[str, str], location: str) -> DataFrame:
    """A catalog table with declared column types (such as ``varchar(50)``) at ``location``; one of that name is replaced."""
    ensure_namespace(spark, database)
    if not name.replace("_", "").isalnum():
        raise ValueError(f"not a plain table name: {name!r}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    spark.sql(f"CREATE TABLE {database}.{name} ({', '.join(f'`{c}` {kind}' for c, kind in columns.items())}) USING parquet LOCATION '{location}'")
    return spark.table(f"{database}.{name}")


def observed_columns(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """Column metadata with what the data shows: filled values and the longest text per column."""
    parts = []
    for name, df in frames.items():
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        one_row = df.selectExpr(
            *[f"count(`{c}`) AS `n_{c}`" for c in df.columns], *[f"max(length(`{c}`)) AS `l_{c}`" for c in texts]
        )
        rows = ", ".join(f"'{c}', `n_{c}`, {f'`l_{c}`' if c in texts else 'CAST(NULL AS INT)'}" for c in df.columns)
        parts.append(
            one_row.selectExpr(f"'{name}' AS table_name", f"stack({len(df.columns)}, {rows}) AS (column_name, filled_values, longest_text)")
        )
    return column_metadata(spark, frames).join(union_all(parts), ["table_name", "column_name"])


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file of a stored table, with its rows, bytes and time of writing.

    Only the hidden metadata is read; no data column is decoded.
    """
    return (
        spark.read.parquet(path)
        .groupBy(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def table_overview(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Name, rows, size in MB and creation time of every table, largest first."""
    parts = [
        table_files(spark, path)
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
            F.round(F.sum("file_size") / F.lit(1024 * 1024).cast("decimal(10,0)"), 2).cast("decimal(18,2)").alias("size_mb"),
            F.min("modified").alias("created"),
        )
        .select(F.lit(name).alias("table_name"), "row_count", "size_mb", "created")
        for name, path in paths.items()
    ]
    return union_all(parts).orderBy(F.desc("row_count"), "table_name")


def storage_metadata(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows and bytes per table. Retention and clustering are attributes Parquet does not have."""
    parts = [
        table_files(spark, path)
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"),
            F.count(F.lit(1)).alias("files"),
        )
        .select(F.lit(name).alias("table_name"), "row_count", "bytes", "files")
        for name, path in paths.items()
    ]
    return union_all(parts).select(
        "*",
        F.lit(None).cast("int").alias("retention_days"),
        F.lit(None).cast("string").alias("clustering_key"),
    )


def preview(df: DataFrame, n: int = 10, order: list[str] | None = None) -> DataFrame:
    """A look at some rows, the first ones of ``order`` if given; the limit is the feature."""
    return (df.orderBy(*order) if order else df).limit(n)
