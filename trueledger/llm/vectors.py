"""Near-duplicate vectors by product quantisation.

Vectors fall into coarse inverted lists by their nearest centroid. What remains of a vector beside its
centroid is coded by the nearest codeword in each subspace. A query visits the lists nearest to it and
gets its distance to every coded vector there by adding up table look-ups. A coded vector lies within
its own, stored, coding error of the true one; so a candidate is dropped only if even that error
cannot bring it within reach, and the rest are settled by the exact cosine. Every vector is a query,
and every one is indexed; only centroids and codewords come from a bounded sample.

Defined results: a null vector, one of zeros or with null or non-finite components links with nothing.
Vectors are compared with those of their length: lengths of few vectors all in one pass, by brute force,
each other one by an index of its own. Equal vectors are one class and linked. Rows with null ids take part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trueledger.llm.common import Batches, groups, slices, stored
from trueledger.llm.components import forest, per_document

THRESHOLD = 0.95
#: Vectors that centroids and codewords are fitted on, at most.
FIT_VECTORS = 20_000
LISTS_AT_MOST = 4096
PROBES = 12
SUBSPACES, CODEWORDS = 8, 64
#: Vectors of a list compared in one block.
BLOCK = 1024


def nearest(x: np.ndarray, centres: np.ndarray, n: int = 1, rows: int = 2048) -> np.ndarray:
    """Numbers of the ``n`` nearest centres of each row, nearest first; ``rows`` at a time."""
    n = min(n, len(centres))
    squares = (centres**2).sum(1)
    out = np.empty((len(x), n), np.int64)
    for at in range(0, len(x), rows):
        d = squares[None, :] - 2 * x[at : at + rows] @ centres.T
        if n == 1:
            out[at : at + rows, 0] = d.argmin(1)
        else:
            some = np.argpartition(d, n - 1, axis=1)[:, :n]
            out[at : at + rows] = np.take_along_axis(some, np.take_along_axis(d, some, 1).argsort(1, kind="stable"), 1)
    return out


def kmeans(x: np.ndarray, k: int, rounds: int = 6, seed: int = 7) -> np.ndarray:
    centres = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, centres)[:, 0]
        sizes = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


class Index:
    """Coarse centroids, and the codewords of each subspace."""

    def __init__(self, sample: np.ndarray, total: int):
        lists = max(1, min(LISTS_AT_MOST, len(sample) // 8, round(4 * math.sqrt(total))))
        self.centres = kmeans(sample, lists)
        rest = sample - self.centres[nearest(sample, self.centres)[:, 0]]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.words = [kmeans(rest[:, p], CODEWORDS) for p in self.parts]

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the distance from each vector to what its code says."""
        rest = x - self.centres[own]
        codes = np.empty((len(x), len(self.parts)), np.uint8)
        error = np.zeros(len(x))
        for i, (p, w) in enumerate(zip(self.parts, self.words, strict=True)):
            codes[:, i] = nearest(rest[:, p], w)[:, 0]
            error += ((rest[:, p] - w[codes[:, i]]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def distances(self, queries: np.ndarray, centre: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances from each query to each coded vector of a list, by table look-ups."""
        rest = queries - self.centres[centre]
        total = np.zeros((len(queries), len(codes)))
        for i, (p, w) in enumerate(zip(self.parts, self.words, strict=True)):
            table = ((rest[:, None, p] - w[None]) ** 2).sum(2)
            total += table[:, codes[:, i]]
        return total


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda v: v != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _block_links(table: pa.Table, index: Index, threshold: float, reach: float) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Counts by row and roots of the links between a block of a list and a block of its visitors."""
    here = table.column("list")[0].as_py()
    keys = table.column("key").combine_chunks()
    is_home = table.column("at_home").to_numpy()
    x = _matrix(table.column("vector").combine_chunks())
    homes = table.column("home").to_numpy()
    probes = np.stack(table.column("probes").to_numpy())
    weight = table.column("n").to_numpy()
    h, v = np.flatnonzero(is_home), np.flatnonzero(~is_home)
    link = np.zeros((len(x), len(x)), bool)
    counts = np.zeros(len(x), np.int64)
    if len(h) and len(v):
        codes, error = index.encode(x[h], np.full(len(h), here))
        near = np.sqrt(index.distances(x[v], here, codes)) <= reach + error[None, :] + 1e-9
        q, c = np.nonzero(near)
        exact = np.einsum("ij,ij->i", x[v[q]], x[h[c]]) >= threshold
        q, c = v[q[exact]], h[c[exact]]
        words = np.array([b.as_py() for b in keys], object)
        # Two of one list meet twice, and two of different lists may meet in either: count one meeting.
        both_here = homes[q] == here
        first = np.where(both_here, words[c] < words[q], ~((homes[q] < here) & (probes[c] == homes[q][:, None]).any(1)))
        different = words[c] != words[q]
        link[q[different], c[different]] = link[c[different], q[different]] = True
        take = (first & different).astype(bool)
        np.add.at(counts, q[take], weight[c[take]])
        np.add.at(counts, c[take], weight[q[take]])
    return counts, forest(link), keys


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, probes: int = PROBES, fit_vectors: int = FIT_VECTORS) -> DataFrame:
    """``id, key, n_links, component_id, kept`` for each row of ``df``; see ``components.per_document``."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector).alias("vector"), F.size(vector).alias("length"), _valid(F.col(vector)).alias("valid"))
    key = F.unhex(F.concat(F.lpad(F.hex(F.xxhash64("vector")), 16, "0"), F.lpad(F.hex(F.xxhash64("vector", F.lit(1))), 16, "0")))
    rows = rows.withColumn("key", F.when(F.col("valid"), key))
    classes = stored(
        rows.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.any_value("vector").alias("vector")), "pq-classes"
    )
    sized = classes.withColumn("length", F.size("vector"))
    lengths = sized.groupBy("length").agg(F.count("*").alias("total"))
    many = lengths.where(F.col("total") > BLOCK).orderBy("length").collect()  # a row for BLOCK vectors at most
    few = lengths.where(F.col("total") <= BLOCK).select("length")
    parts = [_compared(sized.join(few, "length"), threshold)]
    parts += [_searched(classes.where(F.size("vector") == row["length"]), row["total"], threshold, probes, fit_vectors) for row in many]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return per_document(rows.select("id", "key"), classes.select("key", "rep", "n"), found.select(F.col("a").alias("key"), "links"), found.select("a", "b"))


def _forest_rows(keys: pa.Array, counts: np.ndarray, roots: np.ndarray) -> Batches:
    some = np.flatnonzero((counts > 0) | (roots != np.arange(len(roots))))
    if len(some):
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.take(pa.array(some))), pa.array(keys.take(pa.array(roots[some]))), pa.array(counts[some].astype(np.int64))], names=["a", "b", "links"]
        )


def _compared(classes: DataFrame, threshold: float) -> DataFrame:
    """``a, b, links`` of vectors whose lengths have ``BLOCK`` of them at most: all of a length at once."""

    def run(batches: Batches) -> Batches:
        for table in groups(batches, "length"):
            x = _matrix(table.column("vector").combine_chunks())
            link = x @ x.T >= threshold
            np.fill_diagonal(link, False)
            yield from _forest_rows(table.column("key").combine_chunks(), link @ table.column("n").to_numpy(), forest(link))

    dealt = classes.select("length", "key", "n", "vector").repartition("length").sortWithinPartitions("length")
    return stored(dealt.mapInArrow(run, "a binary, b binary, links long"), "pq-links")


def _searched(classes: DataFrame, total: int, threshold: float, probes: int, fit_vectors: int) -> DataFrame:
    """``a, b, links`` of vectors of one length, by an index over them."""
    sample = classes.orderBy(F.xxhash64("key")).limit(fit_vectors).select("vector").toArrow()
    index = Index(_matrix(sample.column("vector").combine_chunks()), total)
    visited = min(probes, len(index.centres))
    reach = math.sqrt(2 - 2 * threshold)

    def place(batches: Batches) -> Batches:
        for batch in slices(batches, 2_000):
            if batch.num_rows:
                found = nearest(_matrix(batch.column(2)), index.centres, visited).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, visited, dtype=np.int32)), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["key", "n", "vector", "probes"])

    kind = classes.schema["vector"].dataType.simpleString()
    placed = stored(classes.select("key", "n", "vector").mapInArrow(place, f"key binary, n long, vector {kind}, probes array<int>"), "pq-placed")
    placed = placed.withColumn("home", F.col("probes")[0])
    visits = placed.select("key", "n", "vector", "probes", "home", F.explode("probes").alias("list"))
    sizes = visits.groupBy("list").agg(F.count("*").alias("visitors"), F.count_if(F.col("list") == F.col("home")).alias("members"))  # a row per list
    visits = visits.join(sizes.where("members > 0"), "list")
    home_blocks, visit_blocks = F.ceil(F.col("members") / BLOCK).cast("int"), F.ceil(F.col("visitors") / BLOCK).cast("int")
    columns = ["list", "key", "n", "vector", "probes", "home"]
    block = lambda blocks: F.pmod(F.xxhash64("key"), blocks).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), blocks - 1))
    homes = visits.where("list = home").select(*columns, block(home_blocks).alias("i"), every(visit_blocks).alias("j"), F.lit(True).alias("at_home"))
    guests = visits.select(*columns, every(home_blocks).alias("i"), block(visit_blocks).alias("j"), F.lit(False).alias("at_home"))
    dealt = homes.unionByName(guests).repartition("list", "i", "j").sortWithinPartitions("list", "i", "j")

    def run(batches: Batches) -> Batches:
        for table in groups(batches, "list", "i", "j"):
            counts, roots, keys = _block_links(table, index, threshold, reach)
            yield from _forest_rows(keys, counts, roots)

    return stored(dealt.mapInArrow(run, "a binary, b binary, links long"), "pq-links")
