"""N-gram Jaccard join by chosen paths.

A text is the set of its runs of ``WORDS`` words. In each run of the join a set chooses some of its
members by a hash that all sets share, then members again under each choice, ``DEPTH`` times: two sets
meet in a bucket where they chose the same path. A member is chosen with probability 1 / (threshold *
set size), so similar sets keep meeting while sets that share little part ways, however common what
they share is. Runs are repeated until a pair exactly at the threshold has met with probability
``RECALL``; more similar pairs meet more surely. Buckets are compared by brute force in blocks of
bounded size. A pair that meets in several buckets counts in the first of them only, which each set's
list of buckets tells, so no table of pairs is ever made.

Defined results: words are what white space separates, as they stand; a text of fewer words is one
run, a text without words links only with texts equal to it. Null text is empty text. Equal texts are
linked (they are one class, whatever their number). Rows with null ids take part; the smallest id of
a component without ids is null. Equality of runs is that of 32-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trueledger.llm.common import Batches, groups, slices, stored, text_key, texts_of
from trueledger.llm.components import forest, per_document

THRESHOLD, WORDS = 0.8, 5
DEPTH = 3
RECALL = 0.999
#: Sets compared in one block; a block pair holds twice as many.
BLOCK = 512
#: Words whose hash a task remembers; beyond it the memory is emptied and filled again.
REMEMBERED = 500_000

_U = np.uint64


def runs_for(recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``.

    At the threshold a shared path goes on in one shared choice on average; a path of ``depth``
    choices is missing with the probability that such a branching has died out by then.
    """
    missed = 0.0
    for _ in range(depth):
        missed = math.exp(missed - 1)
    return math.ceil(math.log(1 - recall) / math.log(missed))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


class Shingles:
    """Sets of hashed word runs."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        split = text.split()
        if not split:
            return np.zeros(0, np.uint64)
        new = set(split).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = set(split)
        for w in new:
            self.known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(self.known.__getitem__, split), np.uint64, len(split))
        n = min(self.words, len(h))
        total = np.zeros(len(h) - n + 1, np.uint64)
        for i in range(n):
            total = total * _U(0x9E3779B97F4A7C15) + h[i : i + len(total)]
        # 32 bits are kept of each, so that everything later sees the same members.
        return np.unique(_mixed(total + _U(n)) >> _U(32))


def paths(members: np.ndarray, runs: int, depth: int = DEPTH, threshold: float = THRESHOLD) -> np.ndarray:
    """The distinct buckets that a set goes to."""
    if not len(members):
        return np.zeros(0, np.int64)
    share = min(1.0, 1.0 / (threshold * len(members)))
    limit = _U(min(int(share * 2.0**64), (1 << 64) - 1))
    spread = _mixed(members + _U(0x9E3779B97F4A7C15))
    nodes = _mixed(np.arange(1, runs + 1, dtype=np.uint64) * _U(0xC2B2AE3D27D4EB4F))
    for _ in range(depth):
        drawn = _mixed(nodes[:, None] ^ spread[None, :])
        at, chosen = np.nonzero(drawn <= limit)
        nodes = _mixed(nodes[at] * _U(0x9E3779B97F4A7C15) + spread[chosen])
    return np.unique(nodes).astype(np.int64)


def _sets(classes: DataFrame, runs: int, depth: int, threshold: float, words: int) -> DataFrame:
    def run(batches: Batches) -> Batches:
        shingles = Shingles(words)
        for batch in slices(batches):
            sets = [shingles(t) for t in texts_of(batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([s.astype("<u4").tobytes() for s in sets], pa.binary()), pa.array([paths(s, runs, depth, threshold) for s in sets], pa.list_(pa.int64()))],
                names=["key", "rep", "n", "members", "paths"],
            )

    rep = classes.schema["rep"].dataType.simpleString()
    return classes.select("key", "rep", "n", "text").mapInArrow(run, f"key binary, rep {rep}, n long, members binary, paths array<long>")


def _block_links(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that count in this block (by row, weighted), and each row's root among all its links."""
    here = table.column("path")[0].as_py()
    first, second = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    raw = [np.frombuffer(m, "<u4") for m in table.column("members").to_pylist()]
    sizes = np.array([len(r) for r in raw])
    owner = np.repeat(np.arange(len(raw)), sizes)
    _, column, times = np.unique(np.concatenate(raw), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    number = np.cumsum(times > 1) - 1
    both = _overlaps(owner[shared], number[column[shared]], len(raw))
    link = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9
    np.fill_diagonal(link, False)
    side = table.column("b").to_numpy()
    if first != second:
        link &= side[:, None] != side[None, :]
    counted = link
    if link.any():
        buckets = table.column("buckets").to_pylist()
        lower = [[p for p in b if p < here] for b in buckets]
        at = np.repeat(np.arange(len(lower)), [len(x) for x in lower])
        if len(at):
            _, code = np.unique(np.concatenate([np.array(x, np.int64) for x in lower]), return_inverse=True)
            counted = link & (_overlaps(at, code, len(lower)) == 0)
    return counted @ table.column("n").to_numpy(), forest(link)


def _overlaps(row: np.ndarray, column: np.ndarray, rows: int, width: int = 2048) -> np.ndarray:
    """How many columns each two rows share, from (row, column) entries."""
    total = np.zeros((rows, rows), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        dense = np.zeros((rows, width), np.float32)
        dense[row[a:b], column[a:b] - start] = 1
        total += dense @ dense.T
    return total


def join(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL, depth: int = DEPTH
) -> DataFrame:
    """``id, key, n_links, component_id, kept`` for each row of ``df``; see ``components.per_document``."""
    rows = df.select(F.col(id_col).alias("id"), text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    classes = rows.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.any_value("text").alias("text"))
    sets = stored(_sets(classes, runs_for(recall, depth), depth, threshold, words), "chosen-sets")

    placed = sets.select("key", F.explode("paths").alias("path"))
    buckets = placed.groupBy("path").agg(
        F.count("*").alias("m"), F.bit_xor(F.xxhash64("key")).alias("s1"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("s2")
    )
    # Buckets with the same sets are compared once.
    compared = stored(buckets.where("m > 1").groupBy("m", "s1", "s2").agg(F.min("path").alias("path")).select("path", "m"), "chosen-buckets")
    held = stored(placed.join(compared, "path"), "chosen-held")
    lists = held.groupBy("key").agg(F.sort_array(F.collect_list("path")).alias("buckets"))
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    cells = held.withColumn("b", F.pmod(F.xxhash64("key", "path"), blocks).cast("int")).select(
        "key", "path", "b", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    )
    cells = cells.select("key", "path", "b", F.least("b", "other").alias("i"), F.greatest("b", "other").alias("j"))
    full = sets.select("key", "n", "members").join(lists, "key")
    shipped = cells.join(full, "key").select("path", "i", "j", "b", "key", "n", "members", "buckets")
    dealt = shipped.repartition("path", "i", "j").sortWithinPartitions("path", "i", "j")

    def run(batches: Batches) -> Batches:
        for table in groups(batches, "path", "i", "j"):
            if table.num_rows < 2:
                continue
            counts, roots = _block_links(table, threshold)
            keys = table.column("key").combine_chunks()
            some = np.flatnonzero((counts > 0) | (roots != np.arange(len(roots))))
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.take(pa.array(some))), pa.array(keys.take(pa.array(roots[some]))), pa.array(counts[some].astype(np.int64))], names=["a", "b", "links"]
                )

    found = stored(dealt.mapInArrow(run, "a binary, b binary, links long"), "chosen-links")
    return per_document(rows.select("id", "key"), sets.select("key", "rep", "n"), found.select(F.col("a").alias("key"), "links"), found.select("a", "b"))
