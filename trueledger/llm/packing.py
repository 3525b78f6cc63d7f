"""Best-fit packing of token documents into sequences, certified by lower bounds.

Documents longer than a sequence are cut into full pieces and one shorter first piece; full pieces
are sequences by themselves. The other pieces are dealt over partitions of bounded size. Each one is
packed by best-fit decreasing and certified: dual feasible functions give a number of sequences below
which no packing of that partition can go. Where all pieces reach their common bound, packing is done. Else
the loosely filled sequences of all partitions exchange their documents: they are dealt
anew over fewer partitions and packed again, until a round saves nothing.

Pieces are known by row numbers that are fixed when they are stored, so documents need no
unique id; repeated rows are packed once for each row, null and empty texts are the separator alone.
"""

from __future__ import annotations

import bisect
from array import array
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trueledger.llm import chunks
from trueledger.llm.common import Batches, slices, stored, texts_of

#: Pieces a partition packs at once; what one task holds.
PARTITION_PIECES = 40_000
#: Sequences filled below this share go on to the exchange.
LOOSE = 0.98
ROUNDS = 4


#: The tokenizer of this Python worker, kept from task to task.
_TOKENIZERS: dict[str, chunks.ChunkIds] = {}


def _library_words(definition: str) -> Callable[[list[bytes]], list[bytes]]:
    """Ids of single words by the model of a byte-level tokenizer of the tokenizers library.

    Its added tokens are ordinary text here, so nothing but the model and the word pattern matters.
    """
    from tokenizers import Tokenizer

    model = Tokenizer.from_str(definition).model
    # The byte-level alphabet: printable Latin-1 stands for itself, other bytes for what follows Latin-1.
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = sorted(set(range(256)) - printable)
    letter = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}

    def encode(words: list[bytes]) -> list[bytes]:
        return [array("I", [t.id for t in model.tokenize(w.decode("latin-1").translate(letter))]).tobytes() for w in words]

    return encode


def token_pieces(df: DataFrame, tokenizer: str, pattern: str, capacity: int = 2048, separator: int = 0, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per piece: ``id_col, piece, start, length, ids`` (``ids`` as little-endian uint32 bytes)."""
    kind = df.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, kind),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()

    def run(batches: Batches) -> Batches:
        if definition not in _TOKENIZERS:
            _TOKENIZERS.clear()
            _TOKENIZERS[definition] = chunks.ChunkIds(chunks.WordIds(pattern, _library_words(definition)))
        ids_of = _TOKENIZERS[definition]
        end = np.array([separator], "<u4").tobytes()
        for batch in slices(batches):
            keys, rows = batch.column(0), []
            for row, raw in enumerate(ids_of(texts_of(batch.column(1)))):
                raw += end
                n = len(raw) // 4
                first = n % capacity or min(n, capacity)
                cuts = [0, *range(first, n + 1, capacity)]
                rows += [(row, p, a, b - a, raw[4 * a : 4 * b]) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
            owner, piece, start, length, ids = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                names=schema.fieldNames(),
            )

    return df.select(id_col, text).mapInArrow(run, schema)


def with_crc32(pieces: DataFrame) -> DataFrame:
    """Pieces with ``ids_crc32`` in place of their ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing of ``lengths`` needs.

    The largest value over the dual feasible functions that count a piece above ``capacity - k`` as a
    whole sequence, one from ``k`` on by its length, and a smaller one as nothing.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    pieces = np.cumsum(counts[::-1])[::-1]
    tokens = np.cumsum((counts * np.arange(capacity + 1))[::-1])[::-1]
    k = np.arange(1, capacity // 2 + 1)
    whole = pieces[np.minimum(capacity - k + 1, capacity)] * capacity
    middle = tokens[k] - tokens[np.minimum(capacity - k + 1, capacity)]
    return max(int(-(-(whole + middle).max() // capacity)), int(-(-tokens[0] // capacity)))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and room left in it before each piece, longest piece first into the fullest bin it fits."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        at = bisect.bisect_left(rooms, need)
        if at < len(rooms):
            room = rooms[at]
            b = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms.pop(at)
        else:
            room, b, made = capacity, made, made + 1
        bins[i], offsets[i] = b, capacity - room
        left = room - need
        if left:
            if not open_by_room[left]:
                bisect.insort(rooms, left)
            open_by_room[left].append(b)
    return bins, offsets


_PACKED = "row long, length long, deal long, bin long, offset long, filled long, gap long"


def _deal(items: DataFrame, parts: int, seed: int) -> DataFrame:
    return items.withColumn("deal", F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(max(1, parts))))


def _packed(items: DataFrame, capacity: int) -> DataFrame:
    """Each group of ``deal`` packed by itself; ``gap`` is its number of sequences above its lower bound."""

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row", ignore_index=True)
        lengths = pdf["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        filled = np.bincount(bins, weights=lengths).astype(np.int64)
        return pdf.assign(bin=bins, offset=offsets, filled=filled[bins], gap=len(filled) - lower_bound(lengths, capacity))

    return items.select("row", "length", "deal").groupBy("deal").applyInPandas(group, _PACKED)


def _global_bound(items: DataFrame, capacity: int) -> int:
    """The lower bound of all pieces together, from their counts by length."""
    rows = items.groupBy("length").count().collect()  # at most ``capacity`` rows
    return lower_bound(np.repeat([r["length"] for r in rows], [r["count"] for r in rows]), capacity)


def pack(pieces: DataFrame, capacity: int = 2048, partition_pieces: int = PARTITION_PIECES, loose: float = LOOSE, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` (rows with a ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Sequence numbers are any distinct longs. Columns of ``pieces`` with these names are replaced.
    """
    numbered = stored(pieces.drop("sequence_id", "offset").withColumn("_row", F.monotonically_increasing_id()), "pack-pieces")
    items = numbered.where(F.col("length") < capacity).select(F.col("_row").alias("row"), "length")
    left, bound = items.count(), _global_bound(items, capacity)
    settled: list[DataFrame] = []
    kept_bins, before, open_bins = 0, None, None
    for turn in range(rounds + 1):
        parts = -(-left // partition_pieces)
        packed = stored(_packed(_deal(items, parts, turn), capacity).withColumn("turn", F.lit(turn)), "pack-round")
        stays = (F.col("filled") >= loose * capacity) if turn < rounds else F.lit(True)
        bins = packed.where(F.col("offset") == 0).agg(F.count("*").alias("n"), F.count_if(stays).alias("stay")).first()
        if open_bins is not None and bins["n"] >= open_bins:
            settled.append(before)
            break
        if parts <= 1 or turn == rounds or kept_bins + bins["n"] <= bound:
            settled.append(packed)
            break
        settled.append(packed.where(stays))
        kept_bins, open_bins, before = kept_bins + bins["stay"], bins["n"] - bins["stay"], packed.where(~stays)
        items = before.select("row", "length")
        left = items.count()
    placed = settled[0]
    for more in settled[1:]:
        placed = placed.unionByName(more)
    number = F.shiftleft(F.col("turn").cast("long"), 59) + F.shiftleft(F.col("deal"), 24) + F.col("bin")
    placed = placed.select(F.col("row").alias("_row"), number.alias("sequence_id"), "offset")
    whole = numbered.where(F.col("length") >= capacity).withColumns({"sequence_id": -1 - F.col("_row"), "offset": F.lit(0).cast("long")})
    rest = numbered.where(F.col("length") < capacity).join(placed, "_row")
    names = [c for c in numbered.columns if c != "_row"] + ["sequence_id", "offset"]
    return whole.select(names).unionByName(rest.select(names))
