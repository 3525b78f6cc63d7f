"""A change-applied table on shared storage, as plain Parquet below one folder.

Every batch of changes is appended as ``batch=<name>/bucket=<n>``, reduced to one row per key. The table
is the latest change per key over all of them, and taking the latest gives the same result however changes
are batched, repeated or ordered. So nothing else has to be kept right: a batch that is replayed after a
restart, two writers at the same time, or a job that dies while it folds leave rows that say the same twice.

A batch counts once Spark's writer has marked it as successful. A bucket that gathers more than
``fold_after`` batches is folded: its latest rows are appended as one batch, then the batches that were
read are removed. Only buckets that changes touch are ever rewritten. A reader whose files a fold
removes while it runs fails with a missing file and is run again.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trueledger.operators.cdc import ORDER, latest_changes, live_rows
from trueledger.operators.evolve import check_additive
from trueledger.sources import files

_PLACE = re.compile(r"/batch=([^/]+)/bucket=(\d+)$")


class ChangeTable:
    """Rows (payload, op, seq, tie) of one table below ``path``, in ``buckets`` buckets by key.

    Choose ``buckets`` so that a bucket is some gigabytes; it is fixed for the life of the table.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64, fold_after: int = 16):
        self.spark, self.path, self.keys, self.buckets, self.fold_after = spark, path.rstrip("/"), keys, buckets, fold_after

    def batches(self) -> dict[int, list[str]]:
        """bucket -> the successful batches that hold rows of it."""
        written = {p.rsplit("/", 2)[1] for p in files.matching(self.spark, f"{self.path}/batch=*/_SUCCESS")}
        out: dict[int, list[str]] = {}
        for folder in files.matching(self.spark, f"{self.path}/batch=*/bucket=*"):
            name, bucket = _PLACE.search(folder).groups()
            if f"batch={name}" in written:
                out.setdefault(int(bucket), []).append(name)
        return out

    def _rows(self, batches: dict[int, list[str]]) -> DataFrame | None:
        """All rows of these buckets and batches; a column is NULL in batches from before it came."""
        folders = [f"{self.path}/batch={name}/bucket={bucket}" for bucket, names in batches.items() for name in names]
        if not folders:
            return None
        return self.spark.read.option("basePath", self.path).option("mergeSchema", "true").parquet(*folders)

    def _latest(self, batches: dict[int, list[str]]) -> DataFrame | None:
        """One row per key, with its ``bucket``. Only buckets of several batches are grouped."""
        rows = self._rows(batches)
        if rows is None:
            return None
        rows = rows.drop("batch")
        several = [bucket for bucket, names in batches.items() if len(names) > 1]
        if not several:
            return rows
        # Of changes with the same place in the order the same one is taken whatever batch it is in.
        content = [c for c in rows.columns if c not in self.keys]
        decided = rows.where(F.col("bucket").isin(several)).withColumn("_decides", F.xxhash64(*content, *[F.col(c).isNull() for c in content]))
        merged = latest_changes(decided, self.keys, [*ORDER, "_decides"]).drop("_decides").select(*rows.columns)
        return merged if len(several) == len(batches) else rows.where(~F.col("bucket").isin(several)).unionByName(merged)

    def state(self) -> DataFrame | None:
        """The latest change per key, deletions included; ``None`` before the first batch."""
        rows = self._latest(self.batches())
        return None if rows is None else rows.drop("bucket")

    def live(self) -> DataFrame | None:
        """The table as it is now; ``None`` before the first batch."""
        state = self.state()
        return None if state is None else live_rows(state)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _append(self, rows: DataFrame) -> str:
        name = f"b{uuid.uuid4().hex}"
        rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/batch={name}")
        return name

    def apply(self, changes: DataFrame) -> list[int]:
        """Append a batch of changes; returns the buckets that it has rows for."""
        before = self._rows(self.batches())
        if before is not None:
            check_additive(before.drop("batch", "bucket").schema, changes.schema)
        name = self._append(latest_changes(changes, self.keys))
        held = self.batches()
        touched = sorted(bucket for bucket, names in held.items() if name in names)
        if not touched:
            files.remove(self.spark, f"{self.path}/batch={name}")
        full = {bucket: held[bucket] for bucket in touched if len(held[bucket]) > self.fold_after}
        if full:
            self._fold(full)
        return touched

    def fold(self) -> None:
        """Every bucket of several batches as one batch."""
        several = {bucket: names for bucket, names in self.batches().items() if len(names) > 1}
        if several:
            self._fold(several)

    def _fold(self, batches: dict[int, list[str]]) -> None:
        self._append(self._latest(batches).drop("bucket"))
        for bucket, names in batches.items():
            for name in names:
                files.remove(self.spark, f"{self.path}/batch={name}/bucket={bucket}")
        for name in {name for names in batches.values() for name in names}:
            if not files.matching(self.spark, f"{self.path}/batch={name}/bucket=*"):
                files.remove(self.spark, f"{self.path}/batch={name}")
