"""Exports: archive by period, storage tiers, CSV fallback, and the dated run log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trueledger.functions import as_of_date
from trueledger.sources import files


def _partitioned(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    """One folder per value. ``rebalance`` gathers small pieces and splits a value that is large."""
    df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(path)


def archive(df: DataFrame, path: str, date_column: str, older_than: dt.date, columns: list[str] | None = None) -> None:
    """Rows from before a day, as Parquet folders per fiscal year and period."""
    _partitioned(df.where(F.col(date_column) < F.lit(older_than)), path, columns or ["fiscal_year", "fiscal_period"])


def tier(date_column: str, as_of: dt.date | None = None) -> Column:
    """hot: up to one year before this year began; archive: more than two years old; else warm."""
    today = as_of_date(as_of)
    this_year = F.trunc(today, "year")
    return (
        F.when(F.col(date_column) >= F.add_months(this_year, -12), "hot")
        .when(F.col(date_column) < F.add_months(today, -24), "archive")
        .otherwise("warm")
    )


def write_tiers(df: DataFrame, path: str, date_column: str, as_of: dt.date | None = None) -> None:
    _partitioned(df.withColumn("tier", tier(date_column, as_of)), path, ["tier"])


#: What keeps a CSV file lossless: blanks, empty text beside NULL, line breaks and microseconds stay.
_CSV = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
#: Read in place of a field that is empty and not quoted, which is how NULL is written.
_NULL = "\u0001NULL\u0001"


def _readable(df: DataFrame) -> DataFrame:
    """``df``, failing on a text that would come back as NULL."""
    taken = F.raise_error(F.lit("a text is the mark that CSV exports read as NULL"))
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(F.col(f"`{c}`") == _NULL, taken.cast("string")).otherwise(F.col(f"`{c}`")) for c in texts})


def export_csv(df: DataFrame, path: str) -> None:
    """``df`` as CSV that ``read_csv`` gives back unchanged. NULL is an empty field, empty text a quoted one."""
    _readable(df).write.mode("overwrite").options(**_CSV).csv(path)


def export_csv_per_role(grants: DataFrame, path: str) -> None:
    """One CSV folder per role, named after it, with the full grant columns inside."""
    named = _readable(grants).withColumn("file", F.concat(F.lower("role"), F.lit("_grants")))
    named.hint("rebalance", "file").write.mode("overwrite").partitionBy("file").options(**_CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """A CSV export as it was written; a line that does not fit the schema fails."""
    options = {**_CSV, "multiLine": "true", "mode": "FAILFAST", "enforceSchema": "false", "nullValue": _NULL, "emptyValue": ""}
    return spark.read.schema(schema).options(**options).csv(path)


def append_log(rows: DataFrame, path: str, time_column: str) -> None:
    """Add rows to a log kept in one folder per day."""
    _partitioned(rows.withColumn("run_date", F.col(time_column).cast("date")), path, ["run_date"], "append")


def retained(log: DataFrame, as_of: dt.date | None = None, days: int = 90) -> DataFrame:
    """The part of a log inside the retention period; older days are pruned, not read."""
    return log.where(F.col("run_date") >= F.date_sub(as_of_date(as_of), days))


def expire_log(spark: SparkSession, path: str, as_of: dt.date, days: int = 90) -> list[dt.date]:
    """Remove the days of a log that lie before the retention period; returns them."""
    first = as_of - dt.timedelta(days=days)
    old = []
    for folder in files.matching(spark, f"{path.rstrip('/')}/run_date=*"):
        day = folder.rsplit("=", 1)[1]
        if day[:1].isdigit() and dt.date.fromisoformat(day) < first:  # rows without a time have a folder of another name
            files.remove(spark, folder)
            old.append(dt.date.fromisoformat(day))
    return old
