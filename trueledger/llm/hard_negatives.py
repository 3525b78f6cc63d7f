"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors are scaled to whole numbers, so that scores (inner products) are exact. They are laid out by
length, label and place on a Hilbert curve through the components that vary most, and cut into blocks of
neighbours; a block is a Parquet row with its vectors and, for every component, its smallest and largest
value (the zone map). Anchors are grouped in the same order.

For each anchor, interval arithmetic over a zone map bounds the scores that a block can hold, and a block
is read only if these bounds meet one of the anchor's windows. A first round reads, in every page of
blocks, the one block whose middle promises most for each window. What it finds raises the windows' lower
ends to the last place that still counts, and the second round reads all blocks that can hold better ones.
So the result is that of comparing each anchor with all rows.

A page holds the zone maps, or the blocks, of a bounded number of neighbours of one label. It is held in a
task while the groups of anchors that it may concern pass by; groups that need none of its blocks are
not sent to it, and blocks that nobody needs are not moved. Rows that leave a page are the best few of
each window, packed by group of anchors.

Defined results: rows without id or label, with a null vector or with null or non-finite components take
no part. Vectors are compared with those of their length only. Rows that have the anchor's id are the
anchor itself and never its positive; repeated rows are rows of their own, both as anchors and as
candidates. At equal scores the smaller id comes first. An anchor without positives, or a positive without
negatives in its window, has no row. An empty table gives an empty result. Components whose scores might not
fit into a long raise ``ArithmeticError``. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trueledger.llm.common import Batches, stored

#: Components that the curve runs through, and bits of each.
CURVE_DIMS, CURVE_BITS = 8, 7

#: Vectors in a block and anchors in a group, and bytes of vectors that neither exceeds by more than a few rows.
BLOCK_ROWS, GROUP_ROWS, BLOCK_BYTES = 256, 128, 1 << 18

#: Blocks in a page, and bytes of vectors in it.
PAGE_BLOCKS, PAGE_BYTES = 512, 1 << 25

#: Rows that go to Python together; they hold whole blocks.
BATCH_ROWS = 32

#: Score of a place that is not taken.
NONE = np.iinfo(np.int64).min


@contextmanager
def _few_rows(spark: SparkSession) -> Iterator[None]:
    """Small batches for rows that hold blocks."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    with _few_rows(df.sparkSession):
        return stored(df, f"negatives-{purpose}")


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- layout


def whole_vectors(df: DataFrame, id: str, vector: str, label: str, scale: int, anchor: Column) -> DataFrame:
    """``id, label, anchor, x array<int>`` of the rows that take part."""
    x = F.col(f"`{vector}`")
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    finite = ~F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    rows = df.where(x.isNotNull() & finite & F.col(f"`{label}`").isNotNull() & F.col(f"`{id}`").isNotNull())
    size = F.size("x").cast("double")
    named = rows.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), scaled.alias("x"), x.alias("raw"))
    top = F.coalesce(F.array_max(F.transform("raw", lambda c: F.abs(c.cast("double") * scale))), F.lit(0.0)) + 1
    over = F.raise_error(F.lit("scores of these vectors may not fit into a long"))
    fits = F.when((top < 2.0**31) & (top * top * size < 2.0**63), F.col("x")).otherwise(over.cast("array<long>"))
    return named.withColumn("x", fits.cast("array<int>")).drop("raw")


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors in the batch: the row numbers, and the vectors as a matrix."""
    column = batch.column(batch.schema.get_field_index("x"))
    flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
    sizes = np.diff(ends)
    starts = ends[:-1] - ends[0]
    for d in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == d)
        yield at, flat[starts[at][:, None] + np.arange(d)]


def _curve(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length of vectors: the components that vary most, with their smallest and largest values."""

    def measure(batches: Batches) -> Batches:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, x in _matrices(batch):
                x = x.astype(float)
                new = np.stack([np.full(x.shape[1], float(len(at))), x.sum(0), (x * x).sum(0), x.min(0), x.max(0)])
                if x.shape[1] in held:
                    old = held[x.shape[1]]
                    new = np.concatenate([old[:3] + new[:3], np.minimum(old[3:4], new[3:4]), np.maximum(old[4:], new[4:])])
                held[x.shape[1]] = new
        for d, m in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d)), pa.array(np.arange(d)), *map(pa.array, m)], ["d", "pos", "n", "s", "ss", "lo", "hi"])

    parts = rows.select("x").mapInArrow(measure, "d long, pos long, n double, s double, ss double, lo double, hi double")
    each = parts.groupBy("d", "pos").agg(*(F.sum(c).alias(c) for c in ("n", "s", "ss")), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    spread = each.withColumn("v", F.col("ss") / F.col("n") - F.pow(F.col("s") / F.col("n"), 2))
    best = spread.withColumn("r", F.row_number().over(Window.partitionBy("d").orderBy(F.desc("v"), "pos"))).where(F.col("r") <= CURVE_DIMS)
    found: dict[int, list] = {}
    for row in best.orderBy("d", "r").collect():  # CURVE_DIMS rows for each length of vectors
        found.setdefault(row["d"], []).append((row["pos"], row["lo"], row["hi"]))
    return {d: tuple(np.array(c) for c in zip(*some, strict=True)) for d, some in found.items()}


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places of whole-number points on the Hilbert curve (Skilling's transform), one point a row."""
    x = [c.astype(np.int64) for c in points.T]
    n = len(x)
    if not n:
        return np.zeros(len(points), np.int64)
    for q in [1 << b for b in range(bits - 1, 0, -1)]:
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = x[0] ^ np.where(set_, q - 1, swap)
            x[i] = x[i] ^ (swap if i else 0)
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(points), np.int64)
    for q in [1 << b for b in range(bits - 1, 0, -1)]:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
    key = np.zeros(len(points), np.int64)
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | ((c ^ turn) >> b & 1)
    return key


def ordered(rows: DataFrame) -> DataFrame:
    """``d, label, key, id, anchor, q``: the rows with their places on the curve of their length."""
    curve = _curve(rows)

    def place(batches: Batches) -> Batches:
        for batch in batches:
            for at, x in _matrices(batch):
                d, n = x.shape[1], len(at)
                key = np.zeros(n, np.int64)
                if d:
                    pos, lo, hi = curve[d]
                    unit = (x[:, pos.astype(int)] - lo) / np.maximum(hi - lo, 1)
                    key = hilbert_keys((unit * ((1 << CURVE_BITS) - 1)).astype(np.int64), CURVE_BITS)
                some = batch.take(pa.array(at))
                data = np.ascontiguousarray(x, "<i4")
                columns = [pa.array(np.full(n, d, np.int32)), some.column("label"), pa.array(key), some.column("id"), some.column("anchor"), pa.array([r.tobytes() for r in data], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["d", "label", "key", "id", "anchor", "q"])

    return rows.mapInArrow(place, "d int, label string, key long, id long, anchor boolean, q binary")


def cut(rows: DataFrame, size: int) -> DataFrame:
    """Ordered rows as blocks: ``page, unit, d, label, n, ids, q, lo, hi``; a page holds blocks of one label."""

    def blocks(batches: Batches) -> Batches:
        part = TaskContext.get().partitionId()
        unit = page = in_page = 0
        kind: tuple | None = None
        ids: list[int] = []
        data: list[bytes] = []

        def block() -> pa.RecordBatch:
            nonlocal unit, page, in_page
            d, label = kind
            x = np.frombuffer(b"".join(data), "<i4").reshape(len(ids), d)
            if in_page >= max(min(PAGE_BLOCKS, PAGE_BYTES // (4 * max(d, 1) * BLOCK_ROWS)), 1):
                page, in_page = page + 1, 0
            row = {"page": part << 32 | page, "unit": part << 32 | unit, "slot": in_page, "d": d, "label": label, "n": len(ids), "ids": np.array(ids, "<i8").tobytes(), "q": x.tobytes(), "lo": x.min(0).tobytes(), "hi": x.max(0).tobytes()}
            unit, in_page = unit + 1, in_page + 1
            ids.clear()
            data.clear()
            return _one(row, _BLOCK)

        for batch in batches:
            for d, label, id, q in zip(*(batch.column(c).to_pylist() for c in ("d", "label", "id", "q")), strict=True):
                if ids and ((d, label) != kind or len(ids) >= max(min(size, BLOCK_BYTES // (4 * max(d, 1))), 16)):
                    yield block()
                if kind is not None and (d, label) != kind:
                    page, in_page = page + 1, 0
                kind = (d, label)
                ids.append(id)
                data.append(q)
        if ids:
            yield block()

    # Copies have one place on the curve and rows may share an id: the last key keeps them from one task.
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    keys = ["d", "label", "key", "id", "tie"]
    return tied.repartitionByRange(_parts(rows.sparkSession), *keys).sortWithinPartitions(*keys).mapInArrow(blocks, _BLOCK)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])


def _one(row: dict, schema: str) -> pa.RecordBatch:
    arrow = _arrow(schema)
    return pa.RecordBatch.from_pylist([{name: row[name] for name in arrow.names}], arrow)


#: A block of vectors, at ``slot`` of its page.
_BLOCK = "page long, unit long, slot int, d int, label string, n int, ids binary, q binary, lo binary, hi binary"

#: A group of ``n`` anchors: their windows (ends, inclusive), and what was found last (scores and ids).
_GROUP = "unit long, d int, label string, n int, ids binary, q binary, windows binary, scores binary, found binary"


def _group(row: dict) -> pa.RecordBatch:
    return _one(row, _GROUP)


# ---------------------------------------------------------------- search


def bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest score that each anchor (row) can have with each zone (column)."""
    plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return product(plus, lo) + product(minus, hi), product(plus, hi) + product(minus, lo)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two whole-number matrices."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    top = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if top < 2.0**53:  # every partial sum is a whole number that a double holds
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def best(places: np.ndarray, scores: np.ndarray, ids: np.ndarray, held: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` of each place: of those held, (places, k), and of the new ones; smaller ids first at ties."""
    old_scores, old_ids = held
    n, k = old_scores.shape
    taken = old_scores.ravel() != NONE
    place = np.concatenate([np.repeat(np.arange(n), k)[taken], places])
    score, id = np.concatenate([old_scores.ravel()[taken], scores]), np.concatenate([old_ids.ravel()[taken], ids])
    order = np.lexsort((id, -score, place))
    place, score, id = place[order], score[order], id[order]
    first = np.searchsorted(place, np.arange(n))
    rank = np.arange(len(place)) - first[place] if len(place) else place
    stays = rank < k
    out = np.full((n, k), NONE), np.zeros((n, k), np.int64)
    out[0][place[stays], rank[stays]] = score[stays]
    out[1][place[stays], rank[stays]] = id[stays]
    return out


def _meet(held: DataFrame, coming: DataFrame, key: str, run: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``run`` over the rows of both sides in order of ``key``, with the held rows of a key (kind 0) first."""
    rows = held.withColumn("kind", F.lit(0)).unionByName(coming.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return rows.repartition(_parts(rows.sparkSession), key).sortWithinPartitions(key, "kind", "unit").mapInArrow(run, schema)


def _rows(batches: Batches) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _ints(data: bytes, *shape: int) -> np.ndarray:
    return np.frombuffer(data, "<i8").reshape(shape)


def _vectors(row: dict) -> np.ndarray:
    return np.frombuffer(row["q"], "<i4").reshape(row["n"], row["d"])


_NEED = "unit long, page long, need binary, slots array<int>"
_PART = "unit long, scores binary, found binary"


def _pairs(groups: DataFrame, blocks: DataFrame, same: bool, salts: int = 16) -> DataFrame:
    """``unit, page``: each group of anchors with the pages whose blocks it may need."""
    pages = blocks.select("page", F.col("d").alias("p_d"), F.col("label").alias("p_label")).distinct()
    ours = F.col("label") == F.col("p_label")
    # Narrow rows; one length or label may hold nearly all of them, so the groups meet the pages in shares.
    left = groups.select("unit", "d", "label").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    right = pages.withColumn("p_salt", F.pmod(F.xxhash64("page"), F.lit(salts)).cast("int"))
    on = (F.col("salt") == F.col("p_salt")) & (F.col("d") == F.col("p_d")) & (ours if same else ~ours)
    return left.join(right, on).select("unit", "page")


def _choose(groups: DataFrame, blocks: DataFrame, same: bool, probe: bool) -> DataFrame:
    """For each page that a group must read, the slots of its blocks, and the anchors (rows) by slots (bits) they need."""

    def run(batches: Batches) -> Batches:
        page, zones, lo = None, [], None
        for row in _rows(batches):
            if row["page"] != page:
                page, zones, lo = row["page"], [], None
            if row["kind"] == 0:
                zones.append(row)
                continue
            if lo is None:
                lo, hi = (np.stack([np.frombuffer(z[c], "<i4") for z in zones]) for c in ("lo", "hi"))
            n = row["n"]
            windows = _ints(row["windows"], n, -1, 2)
            low, high = bounds(_vectors(row), lo, hi)
            middle, reach = low / 2 + high / 2, high.max(1, keepdims=True)
            need = np.zeros(low.shape, bool)
            for w in range(windows.shape[1]):
                meets = (high >= windows[:, w, :1]) & (low <= windows[:, w, 1:])
                if probe:  # the block around the upper end of the window, or of what the page can hold
                    far = np.where(meets, np.abs(middle - np.minimum(windows[:, w, 1:], reach)), np.inf)
                    first = far.argmin(1)
                    some = np.flatnonzero(meets.any(1))
                    need[some, first[some]] = True
                else:
                    need |= meets
            if need.any():
                yield _one({"unit": row["unit"], "page": page, "need": np.packbits(need, axis=1).tobytes(), "slots": np.flatnonzero(need.any(0)).tolist()}, _NEED)

    zones = blocks.select("page", "unit", "d", "lo", "hi")
    sent = _pairs(groups, blocks, same).join(groups.select("unit", "d", "n", "q", "windows"), "unit")
    return _meet(zones, sent, "page", run, _NEED)


def _read(groups: DataFrame, blocks: DataFrame, chosen: DataFrame, k: int) -> DataFrame:
    """``unit, scores, found``: for each page a group reads, the best ``k`` of every anchor and window."""

    def run(batches: Batches) -> Batches:
        page, held = None, {}
        for row in _rows(batches):
            if row["page"] != page:
                page, held = row["page"], {}
            if row["kind"] == 0:
                held[row["slot"]] = _ints(row["ids"], -1), _vectors(row)
                continue
            n, x, own = row["n"], _vectors(row), _ints(row["ids"], -1)
            windows = _ints(row["windows"], n, -1, 2)
            w = windows.shape[1]
            need = np.unpackbits(np.frombuffer(row["need"], np.uint8).reshape(n, -1), axis=1).astype(bool)
            top = np.full((n * w, k), NONE), np.zeros((n * w, k), np.int64)
            for slot in row["slots"]:
                ids, vectors = held[slot]
                who = np.flatnonzero(need[:, slot])
                scores = product(x[who], vectors)
                others = ids[None, :] != own[who, None]
                floor = np.maximum(windows[who, :, 0], top[0].reshape(n, w, k)[who, :, -1])
                fits = (scores[:, None, :] >= floor[:, :, None]) & (scores[:, None, :] <= windows[who, :, 1:]) & others[:, None, :]
                a, v, c = fits.nonzero()
                if len(a):
                    top = best(who[a] * w + v, scores[a, c], ids[c], top)
            if (top[0] != NONE).any():
                yield _one({"unit": row["unit"], "scores": top[0].tobytes(), "found": top[1].tobytes()}, _PART)

    needed = chosen.select("page", F.explode("slots").alias("slot")).distinct()
    used = blocks.select("page", "slot", "unit", "d", "n", "ids", "q").join(needed, ["page", "slot"], "left_semi")
    sent = chosen.join(groups.select("unit", "d", "n", "ids", "q", "windows"), "unit")
    return _meet(used, sent, "page", run, _PART)


def _gather(groups: DataFrame, found: DataFrame, k: int, then: Callable[[dict], dict]) -> DataFrame:
    """The groups, each with the best ``k`` of all its pages for every anchor and window, changed by ``then``."""

    def run(batches: Batches) -> Batches:
        group, top = None, None

        def done() -> Batches:
            if group is not None:
                yield _group(then(group | {"scores": top[0].tobytes(), "found": top[1].tobytes()}))

        for row in _rows(batches):
            if row["kind"] == 0:
                yield from done()
                group = row
                places = len(row["windows"]) // 16
                top = np.full((places, k), NONE), np.zeros((places, k), np.int64)
            else:
                scores, ids = _ints(row["scores"], -1, k), _ints(row["found"], -1, k)
                place, at = (scores != NONE).nonzero()
                top = best(place, scores[place, at], ids[place, at], top)
        yield from done()

    base = groups.select("unit", "d", "label", "n", "ids", "q", "windows")
    return _meet(base, found, "unit", run, _GROUP)


def _raised(k: int) -> Callable[[dict], dict]:
    """Windows from the score of the last place on that still counts, where all places are taken."""

    def then(group: dict) -> dict:
        last = _ints(group["scores"], -1, k)[:, -1]
        windows = _ints(group["windows"], -1, 2).copy()
        windows[:, 0] = np.where(last != NONE, np.maximum(last, windows[:, 0]), windows[:, 0])
        return group | {"windows": windows.tobytes()}

    return then


def search(groups: DataFrame, blocks: DataFrame, same: bool, k: int, then: Callable[[dict], dict], purpose: str) -> DataFrame:
    """The groups with the best ``k`` rows in each window, among rows of the ``same`` or of other labels."""
    probed = _stored(_choose(groups, blocks, same, True), f"{purpose}-probe")
    raised = _stored(_gather(groups, _read(groups, blocks, probed, k), k, _raised(k)), f"{purpose}-raised")
    chosen = _stored(_choose(raised, blocks, same, False), f"{purpose}-chosen")
    return _stored(_gather(raised, _read(raised, blocks, chosen, k), k, then), f"{purpose}-found")


def _whole_line(group: dict) -> dict:
    line = np.array([[NONE + 1, np.iinfo(np.int64).max]])
    return group | {"windows": np.repeat(line, group["n"], 0).astype("<i8").tobytes(), "scores": b"", "found": b""}


def mine(
    df: DataFrame,
    anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each row where ``anchor`` holds, its ``positives`` best rows of the same label, and for each of
    them the ``negatives`` best rows of other labels whose scores lie between the two percentages of the
    positive's score.
    """
    rows = _stored(ordered(stored(whole_vectors(df, id, vector, label, scale, anchor), "negatives-rows")), "ordered")
    blocks = _stored(cut(rows, BLOCK_ROWS), "blocks")

    def begin(batches: Batches) -> Batches:
        whole = np.array([[NONE + 1, np.iinfo(np.int64).max]])
        for row in _rows(batches):
            yield _group(row | {"windows": np.repeat(whole, row["n"], 0).astype("<i8").tobytes(), "scores": b"", "found": b""})

    def around(group: dict) -> dict:
        """A window for each positive; one that nothing fits where there is none."""
        score = _ints(group["scores"], -1)
        hundreds, rest = score // 100, score % 100
        low = -(-low_percent * hundreds + (-low_percent * rest) // 100)
        high = high_percent * hundreds + high_percent * rest // 100
        both = np.stack([np.where(score == NONE, 1, low), np.where(score == NONE, 0, high)], -1)
        return group | {"windows": both.astype("<i8").tobytes()}

    def rows_of(batches: Batches) -> Batches:
        for row in _rows(batches):
            n = row["n"]
            own, positive, p_score = _ints(row["ids"], n), _ints(row["p_found"], n, -1), _ints(row["p_scores"], n, -1)
            score, negative = (_ints(row[c], n, -1, negatives) for c in ("scores", "found"))
            a, w, r = (score != NONE).nonzero()
            columns = [own[a], positive[a, w], (r + 1).astype(np.int32), negative[a, w, r], p_score[a, w], score[a, w, r]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    groups = _stored(cut(rows.where("anchor"), GROUP_ROWS).mapInArrow(begin, _GROUP), "groups")
    found = search(groups, blocks, True, positives, around, "positives")
    mined = search(found, blocks, False, negatives, lambda group: group, "mined")
    kept = found.select("unit", F.col("scores").alias("p_scores"), F.col("found").alias("p_found"))
    out = mined.join(kept, "unit").mapInArrow(rows_of, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return _stored(out, "rows")
