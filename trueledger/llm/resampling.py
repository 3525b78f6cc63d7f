"""Importance resampling towards a target distribution.

Words and runs of words fall into a fixed number of cells. One pass over the corpus and one over the
target texts count the cells; the log ratio of the two distributions gives each cell a gain, kept in one
array. A document's weight is the sum of the gains of its features, its score the weight plus noise
drawn from its id, and the highest scores are the sample (a draw without replacement).

The highest scores are found by a distributed radix sort of the composite key (score, id), least
significant digit first. Each pass is a stable counting sort: rows are counted by digit and block of
places, prefix sums over digits and blocks give every (digit, block) its first destination, and a row's
destination is that plus its place among the rows of its block with the same digit. After the last pass
the destination is the rank. Only rows whose score may be drawn are sorted; a count over the leading
digit tells which. The driver sees counts by cell and by digit, both of fixed size.

Defined results: null and empty texts have no features, weight 0 and at most the noise as score; they
are drawn only if ``least_words`` is 0. A null id gives the noise of the empty id and comes after all
others at equal scores. Ids are integers. Repeated rows are separate rows: of equal ids and scores either
may come first, and each gets a rank of its own. An empty table gives an empty result, an empty target
gains over ``T = 0``. Texts are read whole, in pieces of bounded size. Columns of the input pass through;
those that have the name of an output (``n_words``, ``n_features``, ``weight``, ``score``, ``rank``) are
replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trueledger.llm.common import Batches, slices, stored, unused

#: Bits of a digit: a pass counts up to 4,096 digits in each block.
DIGIT_BITS = 12

#: Places in a block of the passes after the first; in the first pass a block is what one task reads.
BLOCK_BITS = 20

#: Bytes of a text that are cut into words at a time.
PIECE = 1 << 20

#: Lower case for A to Z alone; whatever is no letter, digit or part of a longer character is a space.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def feature_cells(text: str, runs: int, cells: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each piece of a text: how many words it adds, and the cells of the features that end in it."""
    data = text.encode().translate(_WORDS)
    held: list[bytes] = []
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        words = held + data[at:end].split()
        found: list[int] = []
        for n in range(1, runs + 1):
            first = max(len(held) - n + 1, 0)
            some = words[first:] if n == 1 else [b" ".join(words[i : i + n]) for i in range(first, len(words) - n + 1)]
            found.extend(map(zlib.crc32, some))
        yield len(words) - len(held), np.array(found, np.int64) % cells
        held = words[len(words) - runs + 1 :] if runs > 1 else []
        at = end


def cell_counts(df: DataFrame, text: str = "text", runs: int = 1, cells: int = 10_000) -> np.ndarray:
    """How many features of all texts fall into each of ``cells`` cells."""

    def count(batches: Batches) -> Batches:
        total = np.zeros(cells, np.int64)
        for batch in slices(batches):
            for value in batch.column(0).to_pylist():
                for _, found in feature_cells(value or "", runs, cells):
                    total += np.bincount(found, minlength=cells)
        (at,) = total.nonzero()
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    rows = df.select(F.col(text)).mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(cells, np.int64)
    for row in rows:
        out[row["cell"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to corpus, each cell counted once more, rounded down."""
    cells = float(len(corpus))
    s_all, t_all = float(corpus.sum()) + cells, float(target.sum()) + cells
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)])


def with_weights(df: DataFrame, gain: np.ndarray, text: str = "text", runs: int = 1) -> DataFrame:
    """``df`` with ``n_words``, ``n_features`` and ``weight``: the sum of the gains of its features."""
    made = ["n_words", "n_features", "weight"]
    others = [f for f in df.schema.fields if f.name not in made]
    schema = T.StructType([*others, *(T.StructField(name, T.LongType()) for name in made)])
    source = unused(df, "text")
    # The text is handed over under a name of its own, as a column called like an output may hold it.
    handed = df.select(*(F.col(f"`{f.name}`") for f in others), F.col(f"`{text}`").alias(source))

    def weigh(batches: Batches) -> Batches:
        for batch in slices(batches):
            sums = np.zeros((batch.num_rows, 3), np.int64)
            for i, value in enumerate(batch.column(len(others)).to_pylist()):
                for words, found in feature_cells(value or "", runs, len(gain)):
                    sums[i] += words, len(found), gain[found].sum()
            columns = [batch.column(i) for i in range(len(others))]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c) for c in sums.T)], schema.names)

    return handed.mapInArrow(weigh, schema)


def noise(id_col: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate drawn from the id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.ln(-F.ln(uniform))).cast("long")


def scored(df: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", target_text: str = "text", runs: int = 1, cells: int = 10_000, seed: int = 2024) -> DataFrame:
    """``df`` with ``n_words``, ``n_features``, ``weight`` and ``score``."""
    gain = gains(cell_counts(df, text, runs, cells), cell_counts(target, target_text, runs, cells))
    weighed = with_weights(df, gain, text, runs)
    return weighed.withColumn("score", F.col("weight") + noise(F.col(f"`{id}`"), seed))


def radix_ranks(df: DataFrame, digits: list[Column], out: str) -> DataFrame:
    """``df`` with ``out long``: each row's place, from 0, in the order of ``digits``, least significant first.

    Every digit is a whole number from 0 to 2^DIGIT_BITS - 1. Rows with equal digits keep their order.
    """
    digit, block, start, before, local = (unused(df, n) for n in ("digit", "block", "start", "before", "local"))
    placed = stored(df.withColumn(out, F.monotonically_increasing_id()), "radix-0")
    # What a task read has consecutive places from the task's number times 2^33.
    block_of = F.shiftright(F.col(out), 33)
    for i, value in enumerate(digits, 1):
        rows = placed.withColumns({digit: value.cast("int"), block: block_of})
        counts = rows.groupBy(digit, block).agg(F.count(F.lit(1)).alias(local))
        by_digit = counts.groupBy(digit).agg(F.sum(local).alias(start))
        starts = by_digit.withColumn(start, F.sum(start).over(Window.orderBy(digit)) - F.col(start))  # 4,096 rows at most
        behind = F.sum(local).over(Window.partitionBy(digit).orderBy(block)) - F.col(local)
        offsets = counts.withColumn(before, behind).drop(local).join(starts, digit)
        among = F.row_number().over(Window.partitionBy(block, digit).orderBy(out)) - 1
        moved = rows.withColumn(local, among).join(offsets, [block, digit])
        placed = stored(moved.withColumn(out, F.col(start) + F.col(before) + F.col(local)).select(*df.columns, out), f"radix-{i}")
        block_of = F.shiftright(F.col(out), BLOCK_BITS)
    return placed


def _digits(value: Column, bits: int) -> list[Column]:
    """The digits of a number below 2^``bits``, least significant first; the sign bit counts as a bit."""
    return [F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)) for at in range(0, bits, DIGIT_BITS)]


def draw(df: DataFrame, percent: int, id: str = "doc_id", score: str = "score", eligible: Column | None = None) -> DataFrame:
    """``df`` with ``rank``: 1, 2, … for the highest scores, null for rows that are not drawn.

    Drawn are ``percent`` of a hundred of the ``eligible`` rows (rounded down), at equal scores the smaller
    id first. Give narrow rows: they are moved once per digit.
    """
    may = unused(df, "may")
    base = df.drop("rank") if "rank" != score and "rank" != id else df
    kept = stored(base.withColumn(may, F.coalesce(F.lit(True) if eligible is None else eligible, F.lit(False))), "resample")
    key, score_col = F.col(f"`{id}`").cast("long"), F.col(f"`{score}`")
    ends = kept.where(may).agg(F.count(F.lit(1)).alias("n"), F.min(score_col).alias("low"), F.max(score_col).alias("high"), F.min(key).alias("first"), F.max(key).alias("last")).head()
    n = ends["n"] * percent // 100
    if not n:
        return kept.withColumn("rank", F.lit(None).cast("long")).drop(may)

    below = F.lit(ends["high"]) - score_col  # 0 for the highest score
    bits = max((ends["high"] - ends["low"]).bit_length(), 1)
    shift = max(bits - DIGIT_BITS, 0)
    lead = F.shiftright(below, shift)
    seen, last = 0, 0
    for row in sorted(kept.where(may).groupBy(lead.alias("lead")).count().collect()):  # 4,096 rows at most
        seen, last = seen + row["count"], row["lead"]
        if seen >= n:
            break
    # The places below the cut cannot be drawn; the order of the others does not depend on them.
    maybe = F.col(may) & (lead <= last)
    first, final = ends["first"] or 0, ends["last"] or 0
    spread = final - first
    if spread < 1 << 62:
        place = F.coalesce(key - F.lit(first), F.lit(spread + 1))
        digits = _digits(place, (spread + 1).bit_length())
    else:  # the whole range of long: the flipped sign orders it as an unsigned number
        digits = [*_digits(F.coalesce(key, F.lit(0)).bitwiseXOR(F.lit(-(1 << 63))), 64), key.isNull().cast("int")]
    digits += _digits(below, max((((last + 1) << shift) - 1).bit_length(), 1))
    at = unused(kept, "at")
    rank = F.when(F.col(at) < n, F.col(at) + 1)
    drawn = radix_ranks(kept.where(maybe), digits, at).withColumn("rank", rank).drop(at, may)
    rest = kept.where(~maybe).withColumn("rank", F.lit(None).cast("long")).drop(may)
    return drawn.unionByName(rest)
