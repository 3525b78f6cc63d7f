"""Continuous change apply with Structured Streaming."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trueledger.sources.change_table import ChangeTable
from trueledger.sources.exports import append_log
from trueledger.sources.snapshots import reason


def change_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Change files as a stream; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def apply_stream(changes: DataFrame, table: ChangeTable, checkpoint: str, interval: str | None = None, log: str | None = None, name: str = "") -> StreamingQuery:
    """Apply each micro-batch to ``table``. Without ``interval`` what is there is applied and the query ends.

    A micro-batch repeated after a restart is applied again, which changes nothing. With ``log`` each one adds
    a row to the sync log there: ``run_id, table_name, sync_start, sync_end, rows_synced, error`` (times in UTC).
    One that fails is logged with its error, and the query ends with it.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        if log is None:
            table.apply(batch)
            return
        started, rows = _now(), Observation()
        try:
            table.apply(batch.observe(rows, F.count(F.lit(1)).alias("n")))
        except Exception as e:  # whatever it is, the log says so before the query ends
            _log(table, log, (batch_id, name, started, None, reason(e)))
            raise
        _log(table, log, (batch_id, name, started, rows.get["n"], None))

    return started(changes, step, checkpoint, interval)


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def _log(table: ChangeTable, path: str, run: tuple) -> None:
    run_id, name, start, n, error = run
    row = table.spark.createDataFrame([(run_id, name, start, _now(), n, error)], "run_id long, table_name string, sync_start string, sync_end string, rows_synced long, error string")
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("sync_start", "sync_end")}
    append_log(row.withColumns(times), path, "sync_start")


def started(df: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """``step`` for every micro-batch; without ``interval`` for what is there."""
    writer = df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
