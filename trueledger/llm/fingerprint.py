"""Document fingerprints as threshold-scaled sketches.

A sketch retains every shingle hash below a fixed fraction of the hash range, whatever the document's
size. So sketches of parts merge into the sketch of the whole by union, and containment can be
estimated between a sentence and a book. A shingle is a run of ``SHINGLE`` characters; a shorter text
is one shingle. A text with no hash below the threshold keeps its smallest one, which is an estimate
from a single draw. A fingerprint is the sketch as text: sorted hashes of 16 hexadecimal digits.

Defined results: null text is empty text; an empty text has the empty fingerprint; two empty
fingerprints are alike (1), an empty one and another are not (0). Equal texts have equal fingerprints.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trueledger.llm.common import Batches, slices, texts_of

SHINGLE = 12
#: One hash in so many is retained.
SCALE = 16

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _windows(chars: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` characters, by doubling."""
    done, have = None, 0
    block, size = chars, 1
    rest = width
    while rest:
        if rest & 1:
            if done is None:
                done, have = block, size
            else:
                n = min(len(done), len(block) - have)
                done, have = done[:n] * np.uint64(pow(int(_BASE), size, 1 << 64)) + block[have : have + n], have + size
        rest >>= 1
        if rest:
            block = block[:-size] * np.uint64(pow(int(_BASE), size, 1 << 64)) + block[size:]
            size *= 2
    return done


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def sketch(text: str, shingle: int = SHINGLE, scale: int = SCALE) -> np.ndarray:
    """Sorted distinct retained hashes."""
    if not text:
        return np.zeros(0, np.uint64)
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    hashes = _mixed(_windows(chars, min(shingle, len(chars))))
    kept = hashes[hashes < np.uint64((1 << 64) // scale)]
    return np.unique(kept) if len(kept) else hashes.min(keepdims=True)


def as_text(hashes: np.ndarray) -> str:
    return hashes.astype(">u8").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the first text's shingles that the second one holds."""
    if not len(a) or not len(b):
        return float(not len(a))
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a)


def merged(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of two texts taken together (shingles across the seam apart)."""
    both = np.union1d(a, b)
    below = both[both < np.uint64((1 << 64) // scale)]
    return below if len(below) else both[:1]


def add_fingerprints(df: DataFrame, columns: Mapping[str, str], likeness: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """``df`` with a fingerprint column for each ``{new column: text column}``.

    ``likeness`` asks for estimated Jaccard likenesses too: ``{new column: (fingerprint, fingerprint)}``.
    """
    pairs = dict(likeness or {})
    kept = [f for f in df.schema.fields if f.name not in (*columns, *pairs)]
    schema = T.StructType([*kept, *(T.StructField(c, T.StringType()) for c in columns), *(T.StructField(c, T.DoubleType()) for c in pairs)])

    def run(batches: Batches) -> Batches:
        for batch in slices(batches):
            sketches = {c: [sketch(t) for t in texts_of(batch.column(batch.schema.get_field_index(s)))] for c, s in columns.items()}
            made = [pa.array([as_text(x) for x in sketches[c]], pa.string()) for c in columns]
            made += [pa.array([jaccard(x, y) for x, y in zip(sketches[a], sketches[b], strict=True)], pa.float64()) for a, b in pairs.values()]
            old = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*old, *made], names=schema.fieldNames())

    return df.mapInArrow(run, schema)


def with_next(df: DataFrame, order: str, text: str, out: str = "next_text", rows_per_range: int = 8_000) -> DataFrame:
    """``order, text, out``: each row's text and that of the row after it; after the last comes the first.

    Rows are ordered by column ``order`` (nulls last), equal ones by their text. The order is cut into
    ranges of values; each range is sorted by one task and also gets the first row of the range after
    it, so the table moves once and no task sees more than its range.
    """
    total = df.count()
    parts = max(1, math.ceil(total / rows_per_range))
    cuts: list = []
    if parts > 1:
        shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
        cuts = df.agg(F.percentile_approx(order, shares, F.lit(max(10_000, 20 * parts))).alias("q")).first()["q"] or []
    bounds = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("long")
    def range_of(value: pd.Series) -> pd.Series:
        found = np.searchsorted(bounds, value.fillna(0).astype(np.int64), side="right")
        return pd.Series(np.where(value.isna(), len(bounds) + 1, found))

    value = F.col(order).cast("long")
    heads = df.select(value.alias("v")).groupBy(range_of("v").alias("r")).agg(F.min("v").alias("v")).orderBy("r").collect()
    numbers = np.array([h["r"] for h in heads], np.int64)
    firsts = {h["r"]: h["v"] for h in heads}
    before = {int(r): int(numbers[i - 1]) for i, r in enumerate(numbers)}

    @F.pandas_udf("long")
    def also_in(r: pd.Series, value: pd.Series) -> pd.Series:
        """The range before, for rows that stand first in theirs."""
        first = r.map(firsts)
        is_first = (first == value) | (first.isna() & value.isna())
        return r.map(before).where(is_first).astype("Int64")

    ranged = df.select(value.alias("_v"), F.col(order), F.col(text)).withColumn("_r", range_of("_v"))
    copies = ranged.withColumn("_to", also_in("_r", "_v"))
    dealt = copies.select(
        order, text, "_v", F.explode(F.array_compact(F.array(F.struct(F.col("_r").alias("r"), F.lit(0).alias("lap")), F.when(F.col("_to").isNotNull(), F.struct(F.col("_to").alias("r"), F.lit(1).alias("lap")))))).alias("_at")
    ).select(F.col("_at.r").alias("_r"), F.col("_at.lap").alias("_lap"), "_v", order, text)
    sorted_ranges = dealt.repartition(parts, "_r").sortWithinPartitions("_r", "_lap", F.col("_v").asc_nulls_last(), text)
    schema = T.StructType([df.schema[order], T.StructField(text, T.StringType()), T.StructField(out, T.StringType())])

    def run(batches: Batches) -> Batches:
        last = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if last is None else [last, batch]).combine_chunks()
            n = table.num_rows
            if n > 1:
                own, following = table.slice(0, n - 1), table.column(4).slice(1)
                pairs = pa.table([own.column(3), own.column(4), following], names=schema.fieldNames())
                yield from pairs.filter(pa.compute.equal(own.column(1), 0)).to_batches()
            last = table.slice(n - 1).to_batches()[0] if n else last

    return sorted_ranges.mapInArrow(run, schema)
