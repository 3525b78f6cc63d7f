"""Change counts per interval: of a table of changes, and kept up to date from a stream of them.

A streaming aggregate behind a watermark forgets old intervals and drops, without a word, the changes
that arrive for them later. Here no interval is ever closed. Each micro-batch is counted by itself and its
counts (a few rows) are written under the batch's number, so a batch that is replayed overwrites what it
wrote before. Changes older than the newest one of earlier batches by more than ``lateness`` are counted
like all others, and once more as late, so that a report can say which intervals were corrected afterwards.

Nothing grows but the result: after ``fold_after`` batches their counts are summed into one folder, named
by the last batch it covers, and the folders it replaces are removed. The newest such folder and the
batches after it are the counts; a job that dies in between leaves only what is not read any more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trueledger.sources import files
from trueledger.sources.tables import read_if_present
from trueledger.streaming.cdc_stream import started

KEYS = ["interval_start", "interval_end", "op"]


def change_counts(changes: DataFrame, interval: str = "15 minutes") -> DataFrame:
    """Changes per operation and interval; those without a time have an interval without ends."""
    return _counts(changes, interval, F.count(F.lit(1)).alias("change_count"))


def _counts(changes: DataFrame, interval: str, *measures) -> DataFrame:
    # Windows leave out rows without a time.
    timed = changes.groupBy(F.window("seq", interval).alias("w"), "op").agg(*measures)
    timed = timed.select(F.col("w.start").alias("interval_start"), F.col("w.end").alias("interval_end"), "op", *timed.columns[2:])
    untimed = changes.where(F.col("seq").isNull()).groupBy("op").agg(*measures)
    return timed.unionByName(untimed, allowMissingColumns=True)


def _behind(parts: DataFrame, lateness: str, seq: str) -> Column:
    """The time from which on changes are not late; NULL where none has been counted."""
    at = F.max("newest") - F.expr(f"INTERVAL {lateness}")
    if seq == "timestamp":  # as a number: an instant's text is ambiguous when clocks are set back
        return F.timestamp_micros(F.lit(parts.agg(F.unix_micros(at)).first()[0]).cast("bigint"))
    return F.lit(parts.agg(at.cast("string")).first()[0]).cast(seq)


class CountTable:
    """Counts of a stream of changes below ``path``; ``seq`` is a time, zone-free or not."""

    def __init__(self, spark: SparkSession, path: str, interval: str = "15 minutes", lateness: str = "1 hour", fold_after: int = 32):
        self.spark, self.path, self.interval, self.lateness, self.fold_after = spark, path.rstrip("/"), interval, lateness, fold_after

    def _schema(self, seq: str) -> str:
        return f"interval_start {seq}, interval_end {seq}, op string, change_count bigint, late_count bigint, newest {seq}"

    def _parts(self, seq: str) -> tuple[int, DataFrame]:
        """The last batch that has been folded (-1 where none has), and all counts with their ``batch_id``."""
        folded = read_if_present(self.spark, f"{self.path}/folded", f"{self._schema(seq)}, through bigint")
        through = folded.agg(F.coalesce(F.max("through"), F.lit(-1))).first()[0]
        base = folded.where(F.col("through") == through).withColumnRenamed("through", "batch_id")
        since = read_if_present(self.spark, f"{self.path}/batches", f"{self._schema(seq)}, batch_id bigint").where(F.col("batch_id") > through)
        return through, base.unionByName(since)

    def _summed(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(*KEYS).agg(F.sum("change_count").alias("change_count"), F.sum("late_count").alias("late_count"), F.max("newest").alias("newest"))

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Count a micro-batch; adding the last one again replaces what it added."""
        seq = batch.schema["seq"].dataType.simpleString()
        through, parts = self._parts(seq)
        earlier = parts.where(F.col("batch_id") < batch_id)
        late = F.coalesce(F.col("seq") < _behind(earlier, self.lateness, seq), F.lit(False))
        counts = _counts(batch, self.interval, F.count(F.lit(1)).alias("change_count"), F.count_if(late).alias("late_count"), F.max("seq").alias("newest"))
        counts.select(*KEYS, "change_count", "late_count", "newest").write.mode("overwrite").parquet(f"{self.path}/batches/batch_id={batch_id}")
        if batch_id - through > self.fold_after:
            self._fold(earlier, through, batch_id - 1)

    def _fold(self, parts: DataFrame, before: int, through: int) -> None:
        """Batches up to ``through`` as one folder; the batch after it may still be replayed and stays."""
        self._summed(parts).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/folded/through={through}")
        for number in range(before + 1, through + 1):
            files.remove(self.spark, f"{self.path}/batches/batch_id={number}")
        files.remove(self.spark, f"{self.path}/folded/through={before}")

    def counts(self, seq: str = "timestamp_ntz") -> DataFrame:
        """``interval_start, interval_end, op, change_count, late_count`` of all batches so far."""
        return self._summed(self._parts(seq)[1]).drop("newest")


def count_stream(changes: DataFrame, table: CountTable, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Count each micro-batch of ``changes`` into ``table``."""
    return started(changes, table.add, checkpoint, interval)
