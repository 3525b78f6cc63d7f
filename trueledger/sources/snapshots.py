"""Loading tables and copying them as numbered Parquet versions.

A version becomes visible only through its manifest row, which is written after its data. A job
that dies half-way leaves files nobody reads.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor, as_completed

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trueledger.schemas import TABLES
from trueledger.sources.tables import read_if_present, row_counts, table_files, union_all

MANIFEST = "table_name string, version int, row_count bigint, label string"
#: What a failing write raises: errors that PySpark maps to its own, and those of the JVM as they are.
FAILURES = (PySparkException, Py4JError)
LOAD_REPORT = "table_name string, loaded boolean, error string"


def reason(error: Exception) -> str:
    """What went wrong, without the traces of the calls it came through."""
    cause = getattr(error, "java_exception", None)
    while cause is not None and cause.getCause() is not None:
        cause = cause.getCause()
    return str(error) if cause is None else str(cause.getMessage())


def load(
    spark: SparkSession,
    frames: dict[str, DataFrame],
    root: str,
    mode: str = "overwrite",
    max_records_per_file: int = 5_000_000,
    at_once: int = 3,
) -> DataFrame:
    """Write every table below ``root``, small ones first. One table failing does not stop the rest."""

    def write(name: str) -> tuple[str, bool, str | None]:
        try:
            frames[name].write.mode(mode).option("maxRecordsPerFile", max_records_per_file).parquet(f"{root}/{name}")
        except FAILURES as e:
            return name, False, str(e)
        return name, True, None

    order = [t for t in TABLES if t in frames] + [t for t in frames if t not in TABLES]
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        report = list(pool.map(write, order))
    return spark.createDataFrame(report, LOAD_REPORT)


def load_into(frames: dict[str, DataFrame], database: str, root: str | None = None) -> None:
    """The same load into catalog tables, created from the frame's schema; files below ``root`` if given."""
    for name, df in frames.items():
        writer = df.write.mode("overwrite").format("parquet")
        (writer.option("path", f"{root}/{name}") if root else writer).saveAsTable(f"{database}.{name}")


def verify_load(spark: SparkSession, root: str, expected: DataFrame) -> DataFrame:
    """Stored row count of each table against ``expected`` (table_name, row_count); a missing table is not valid."""
    stored = {}
    for row in expected.select("table_name").collect():
        try:
            stored[row.table_name] = spark.read.parquet(f"{root}/{row.table_name}")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    expected = expected.withColumnRenamed("row_count", "expected_count")
    if stored:
        expected = expected.join(row_counts(stored), "table_name", "left")
    else:
        expected = expected.withColumn("row_count", F.lit(None).cast("bigint"))
    return expected.select(
        "table_name",
        "row_count",
        "expected_count",
        F.coalesce(F.col("row_count") == F.col("expected_count"), F.lit(False)).alias("valid"),
    )


def load_summary(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """Tables, rows and gigabytes below ``root``."""
    files = union_all([table_files(spark, f"{root}/{name}").select("rows", "file_size") for name in names])
    giga = F.lit(1024**3).cast("decimal(12,0)")
    return files.agg(
        F.lit(len(names)).cast("bigint").alias("tables"),  # each was read; one without rows has no file metadata
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.round(F.coalesce(F.sum("file_size"), F.lit(0)) / giga, 2).cast("decimal(18,2)").alias("total_gb"),
    )


def _manifest(root: str) -> str:
    return f"{root}/_manifest"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """Published versions: ``table_name, version, row_count, label``."""
    return read_if_present(spark, _manifest(root), MANIFEST)


def _newest(published: DataFrame) -> int:
    return published.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def latest_version(spark: SparkSession, root: str, table: str) -> int:
    """0 where nothing has been published yet."""
    return _newest(versions(spark, root).where(F.col("table_name") == table))


def labelled_version(spark: SparkSession, root: str, table: str, label: str) -> int:
    """The newest version published under ``label``; 0 where there is none."""
    return _newest(versions(spark, root).where((F.col("table_name") == table) & (F.col("label") == label)))


def snapshot(spark: SparkSession, frames: dict[str, DataFrame], root: str, label: str | None = None) -> DataFrame:
    """Copy whole tables into their next version and publish each one when it is complete.

    Rows are counted as they are written, so the copy is not read again. All tables are copied at the
    same time; one that fails stays at its old version and does not keep the others from being published.
    The first failure is raised and names the others. Running it again is a full re-sync: it publishes a
    further version. A ``label`` names the versions for good, as a backup to come back to.
    """

    def copy(name: str) -> tuple[str, int, int, str | None]:
        version = latest_version(spark, root, name) + 1
        rows = Observation()
        counted = frames[name].observe(rows, F.count(F.lit(1)).alias("n"))
        counted.write.mode("overwrite").parquet(version_path(root, name, version))
        return name, version, rows.get["n"], label

    published, failures = [], []
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        for copied in as_completed([pool.submit(copy, name) for name in frames]):
            try:
                entry = spark.createDataFrame([copied.result()], MANIFEST)
            except FAILURES as e:
                failures.append(e)
                continue
            # One writer at a time: appends to the manifest come from this thread only.
            entry.coalesce(1).write.mode("append").parquet(_manifest(root))
            published.append(entry)
    if failures:
        for other in failures[1:]:
            failures[0].add_note(f"another table failed as well: {other}")
        raise failures[0]
    return union_all(published)


def version_path(root: str, table: str, version: int) -> str:
    return f"{root}/{table}/v={version}"


def read_version(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """A published version of a table; the latest by default."""
    version = latest_version(spark, root, table) if version is None else version
    return spark.read.parquet(version_path(root, table, version))
