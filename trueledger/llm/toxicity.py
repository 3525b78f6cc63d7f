"""Toxicity from class-conditional Kneser-Ney models over the letters of words.

Two models, of toxic and of ordinary labelled documents, predict each letter of a word from up to four
before it. At the longest context a class uses its own discounted counts; below it both back off to
shared continuation counts (in how many contexts an expression occurs), gathered from the vocabulary
of all documents. So an expression that is rare in both classes scores alike in both, and one that a
class prefers scores for it, also in word forms that were never labelled. A word's score is the mean
over its letters of the log-likelihood ratio; a document is described by the mean over all its words
and its highest words, and a logistic curve fitted on other labelled rows turns that into 0 to 1.

Counts are kept by the whole 64-bit hash of a letter run, and Spark makes one log-likelihood ratio of
each run at a longest context. Up to ``BROADCAST_RUNS`` of these are broadcast; with more, words are
joined to their runs and documents to their words.

Defined results: null text is empty text; an empty text gets the score of a document without
evidence. Rows repeated in the documents or the labels count as often as they stand there; null labels
or ids teach nothing, but a document with a null id is scored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trueledger.llm.common import Batches, slices, stored, texts_of, unused

ORDER = 5
#: Cells of the small tables that ``Model`` reads.
CELLS = 1 << 20
#: Letter runs with a ratio other than 0 that are broadcast, at 16 bytes each.
BROADCAST_RUNS = 4_000_000
DISCOUNT = 0.75
#: Labelled rows that the logistic curve is fitted on, at most. Chosen by a hash of the id.
FIT_ROWS = 20_000
#: Words a task remembers the score of; beyond it the memory is emptied and filled again.
REMEMBERED = 400_000
#: Letters that the last backoff level spreads its probability over.
ALPHABET = 1000

_WORDS = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def _hashed(parts: np.ndarray, length: int) -> np.ndarray:
    h = parts + np.uint64(length * 0xC2B2AE3D27D4EB4F % (1 << 64))
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))).astype(np.int64)


@dataclass
class Letters:
    """All letters of some words, with a start and an end mark, one after the other."""

    word: np.ndarray
    place: np.ndarray
    hashes: list[np.ndarray]

    @classmethod
    def of(cls, words: list[str]) -> Letters:
        joined = "".join(f"\x02{w}\x03" for w in words)
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        sizes = np.array([len(w) + 2 for w in words], np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        raw, hashes = np.zeros(len(chars), np.uint64), [_hashed(np.zeros(len(chars), np.uint64), 0)]
        for n in range(1, ORDER + 1):
            raw = np.concatenate([raw[:1] * np.uint64(0), raw[:-1]]) * _BASE + chars + np.uint64(1)
            hashes.append(_hashed(raw, n))
        return cls(word, place, hashes)

    def gram(self, n: int, at: np.ndarray) -> np.ndarray:
        """Hash of the ``n`` letters that end at each place."""
        return self.hashes[n][at]

    def context(self, n: int, at: np.ndarray) -> np.ndarray:
        """Hash of the ``n`` letters before each place."""
        return self.hashes[n][at - 1] if n else self.hashes[0][at]


# ------------------------------------------------------------------ counting


#: Counts of the classes: from all labelled rows that may teach, and from those the curve is not fitted on.
CLASSES = ["toxic", "ordinary", "fit_toxic", "fit_ordinary"]


def bags(df: DataFrame) -> DataFrame:
    """``_id`` and ``_bag`` of ``_id`` and ``_text``: the words in order of the alphabet, packed, about half of what the text takes."""

    def run(batches: Batches) -> Batches:
        for batch in slices(batches):
            packed = [zlib.compress(" ".join(sorted(words_of(t))).encode(), 3) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["_id", "_bag"])

    kind = T.StructType([df.schema["_id"], T.StructField("_bag", T.BinaryType())])
    return df.select("_id", "_text").mapInArrow(run, kind)


def word_counts(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """``word`` and ``CLASSES`` of ``_id, _text``: occurrences in texts of ids that ``marks`` (one row per id) has; other words have zeros.

    Only texts whose id may teach move to their marks, as bags of words.
    """

    def run(batches: Batches) -> Batches:
        counts: dict[int, Counter] = {}
        plain: set[str] = set()
        for batch in slices(batches):
            bag, third, *weights = (c.to_pylist() for c in batch.columns)
            for packed, f, *times in zip(bag, third, *weights, strict=True):
                words = zlib.decompress(packed).decode().split()
                if not any(times):
                    plain.update(words)
                for mark, n in enumerate(times):
                    if n == 1:
                        counts.setdefault(2 * f + mark, Counter()).update(words)
                    elif n:
                        counts.setdefault(2 * f + mark, Counter()).update({w: n * k for w, k in Counter(words).items()})
            if sum(map(len, counts.values())) + len(plain) > REMEMBERED:
                yield _counted(counts, plain)
                counts, plain = {}, set()
        yield _counted(counts, plain)

    def unmarked(batches: Batches) -> Batches:
        plain: set[str] = set()
        for batch in slices(batches):
            for t in texts_of(batch.column(0)):
                plain.update(words_of(t))
            if len(plain) > REMEMBERED:
                yield _counted({}, plain)
                plain = set()
        yield _counted({}, plain)

    kinds = "word string, " + ", ".join(f"{c} double" for c in CLASSES)
    teaches = F.coalesce(fold(F.col("_id")) != 1, F.lit(False))
    weight = lambda c: F.coalesce(F.col(c), F.lit(0))
    moved = bags(texts.where(teaches)).join(marks, "_id", "left").select("_bag", fold(F.col("_id")).cast("int"), weight("_ordinary"), weight("_toxic"))
    made = moved.mapInArrow(run, kinds).unionByName(texts.where(~teaches).select("_text").mapInArrow(unmarked, kinds))
    return made.groupBy("word").agg(*(F.sum(c).alias(c) for c in CLASSES))


def _counted(counts: dict[int, Counter], plain: set[str]) -> pa.RecordBatch:
    words = list(plain.union(*counts.values()))
    n = {g: np.fromiter((counts[g][w] for w in words), float, len(words)) if g in counts else np.zeros(len(words)) for g in range(6)}
    columns = [n[1] + n[5], n[0] + n[4], n[1], n[0]]
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *map(pa.array, columns)], names=["word", *CLASSES])


def gram_counts(words: DataFrame) -> DataFrame:
    """``gram, context, suffix, n, top`` and ``CLASSES``: distinct letter runs of up to ``ORDER``."""

    def run(batches: Batches) -> Batches:
        for batch in slices(batches, 20_000):
            letters = Letters.of(batch.column(0).to_pylist())
            weights = [batch.column(1 + i).to_numpy() for i in range(len(CLASSES))]
            for n in range(1, ORDER + 1):
                at = np.flatnonzero((letters.place >= n - 1) & (letters.place >= 1))
                if not len(at):
                    continue
                grams, first, inverse = np.unique(letters.gram(n, at), return_index=True, return_inverse=True)
                one = at[first]
                top = (letters.place[one] == n - 1) | (n == ORDER)
                sums = [np.bincount(inverse, weights=w[letters.word[at]], minlength=len(grams)) for w in weights]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams), pa.array(letters.context(n - 1, one)), pa.array(letters.gram(n - 1, one)), pa.array(np.full(len(grams), n, np.int32)), pa.array(top), *map(pa.array, sums)],
                    names=["gram", "context", "suffix", "n", "top", *CLASSES],
                )

    kinds = "gram long, context long, suffix long, n int, top boolean, " + ", ".join(f"{c} double" for c in CLASSES)
    made = words.select("word", *CLASSES).mapInArrow(run, kinds)
    return made.groupBy("gram").agg(*(F.max(c).alias(c) for c in ("context", "suffix", "n", "top")), *(F.sum(c).alias(c) for c in CLASSES))


#: ``n_`` counts of grams, ``c_`` of contexts, ``t_`` of the letters that follow a context.
COLUMNS = [f"{kind}_{c}" for kind in "nct" for c in [*CLASSES, "shared"]]


def run_ratios(grams: DataFrame) -> DataFrame:
    """``gram, whole, fit``: log P(letter | toxic) - log P(letter | ordinary) of letter runs at a longest context.

    ``whole`` is by the counts of all rows that teach, ``fit`` by those the curve is not fitted on. Runs
    that are not there have 0 in both.
    """
    top = grams.where("top")
    by_context = top.where("toxic + ordinary > 0").groupBy("context").agg(
        *(F.sum(c).alias(f"c_{c}") for c in CLASSES), *(F.count_if(F.col(c) > 0).alias(f"t_{c}") for c in CLASSES)
    )
    # The suffix of a gram of n letters is one of n - 1; each such gram is one more letter it follows.
    kept = grams.where("n > 1").groupBy(F.col("suffix").alias("gram")).agg(F.count("*").alias("n_shared"))
    counted = stored(kept.join(grams.select("gram", "context", "suffix", "n"), "gram"), "toxicity-shared")
    by_shared = counted.groupBy("context").agg(F.sum("n_shared").alias("c_shared"), F.count("*").alias("t_shared"))
    levels = stored(counted.join(by_shared, "context"), "toxicity-levels")
    shared: list[DataFrame] = []
    for n in range(1, ORDER):
        level = levels.where(F.col("n") == n)
        if shared:
            level = level.join(shared[-1].select(F.col("gram").alias("suffix"), F.col("shared").alias("below")), "suffix")
        else:
            level = level.withColumn("below", F.lit(1.0 / ALPHABET))
        own = F.greatest(F.col("n_shared") - DISCOUNT, F.lit(0.0))
        shared.append(stored(level.select("gram", ((own + DISCOUNT * F.col("t_shared") * F.col("below")) / F.col("c_shared")).alias("shared")), "toxicity-level"))
    below = shared[0]
    for more in shared[1:]:
        below = below.unionByName(more)

    def log_likelihood(c: str) -> Column:
        own = F.greatest(F.col(c) - DISCOUNT, F.lit(0.0))
        seen = (own + DISCOUNT * F.least(f"t_{c}", f"c_{c}") * F.col("shared")) / F.greatest(F.col(f"c_{c}"), F.lit(1.0))
        return F.log(F.when(F.col(f"c_{c}") > 0, seen).otherwise(F.col("shared")))

    joined = top.join(by_context, "context").join(below.withColumnRenamed("gram", "suffix"), "suffix")
    whole, fit = (log_likelihood(a) - log_likelihood(b) for a, b in (CLASSES[:2], CLASSES[2:]))
    return joined.select("gram", whole.cast("float").alias("whole"), fit.cast("float").alias("fit")).where("whole <> 0 or fit <> 0")


# ------------------------------------------------------------------- scoring


#: ``n_`` counts of grams, ``c_`` of contexts, ``t_`` of the letters that follow a context.
COLUMNS = [f"{kind}_{c}" for kind in "nct" for c in [*CLASSES, "shared"]]


class Model:
    """The two class models of a few words from plain count tables (``CELLS`` floats each): what ``run_ratios`` is tested against."""

    def __init__(self, tables: dict[str, np.ndarray], classes: list[str]):
        self.tables, self.classes = tables, classes

    def _get(self, name: str, hashes: np.ndarray) -> np.ndarray:
        return self.tables[name][hashes & (CELLS - 1)].astype(np.float64)

    def ratios(self, words: list[str]) -> np.ndarray:
        """Mean over each word's letters of log P(letter | toxic) - log P(letter | ordinary)."""
        letters = Letters.of(words)
        at = np.flatnonzero(letters.place >= 1)
        place = letters.place[at]
        shared = np.full(len(at), 1.0 / ALPHABET)
        for n in range(1, ORDER):
            has = place >= n
            here = at[has]
            total, kinds = (self._get(c, letters.context(n - 1, here)) for c in ("c_shared", "t_shared"))
            own = np.maximum(self._get("n_shared", letters.gram(n, here)) - DISCOUNT, 0)
            shared[has] = np.where(total > 0, (own + DISCOUNT * kinds * shared[has]) / np.maximum(total, 1), shared[has])
        longest = np.minimum(place + 1, ORDER)
        gram, context = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        for n in range(2, ORDER + 1):
            here = longest == n
            gram[here], context[here] = letters.gram(n, at[here]), letters.context(n - 1, at[here])
        logs = []
        for c in self.classes:
            total, kinds = self._get(f"c_{c}", context), self._get(f"t_{c}", context)
            own = np.maximum(self._get(f"n_{c}", gram) - DISCOUNT, 0)
            logs.append(np.log(np.where(total > 0, (own + DISCOUNT * np.minimum(kinds, total) * shared) / np.maximum(total, 1), shared)))
        sums = np.bincount(letters.word[at], weights=logs[0] - logs[1], minlength=len(words))
        return sums / np.array([len(w) + 1 for w in words])


def longest_runs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each letter of each word, the number of its word and the hash of the longest run that ends there."""
    letters = Letters.of(words)
    at = np.flatnonzero(letters.place >= 1)
    longest, gram = np.minimum(letters.place[at] + 1, ORDER), np.empty(len(at), np.int64)
    for n in range(2, ORDER + 1):
        here = longest == n
        gram[here] = letters.gram(n, at[here])
    return letters.word[at], gram


class Scorer:
    """Scores of words from the ratios of all runs (``grams`` in rising order)."""

    def __init__(self, grams: np.ndarray, ratios: np.ndarray):
        self.grams, self.values = grams, ratios
        self.known: dict[str, float] = {}

    def ratios(self, words: list[str]) -> np.ndarray:
        """Mean over each word's letters of log P(letter | toxic) - log P(letter | ordinary)."""
        word, runs = longest_runs(words)
        found = np.zeros(len(runs))
        if len(self.grams):
            at = np.minimum(np.searchsorted(self.grams, runs), len(self.grams) - 1)
            found = np.where(self.grams[at] == runs, self.values[at], 0.0)
        return np.bincount(word, weights=found, minlength=len(words)) / np.array([len(w) + 1 for w in words])

    def features(self, texts: list[str]) -> np.ndarray:
        split = [words_of(t) for t in texts]
        distinct = set().union(*split)
        if len(self.known) + len(distinct) > REMEMBERED:
            self.known.clear()
        new = list(distinct.difference(self.known))
        for i in range(0, len(new), 50_000):
            self.known.update(zip(new[i : i + 50_000], self.ratios(new[i : i + 50_000]).tolist(), strict=True))
        get = self.known.__getitem__
        out = np.zeros((len(texts), FEATURES))
        for i, words in enumerate(split):
            if words:
                mean = np.fromiter(map(get, words), float, len(words))
                whole = mean * (np.fromiter(map(len, words), float, len(words)) + 1)
                out[i, 0] = mean.mean()
                out[i, 1] = np.log1p(len(words))
                out[i, 2:5], out[i, 5:8] = _highest(mean), _highest(whole)
        return out


FEATURES = 8


def _highest(values: np.ndarray, n: int = 3) -> np.ndarray:
    """The ``n`` highest values in falling order, zeros where there are fewer."""
    top = np.sort(np.partition(values, len(values) - n)[-n:] if len(values) > n else values)[::-1]
    return np.concatenate([top, np.zeros(n - len(top))])


def joined_features(rows: DataFrame, runs: DataFrame, ratio: str) -> DataFrame:
    """``_row, _x``: the features of ``_row, _text`` by joins alone, for more runs than a broadcast holds; texts without words have no row."""

    def word_rows(batches: Batches) -> Batches:
        for batch in slices(batches, 100):
            owner, words, times = [], [], []
            for row, t in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                count = Counter(words_of(t))
                owner += [row] * len(count)
                words += count
                times += count.values()
            yield pa.RecordBatch.from_arrays([pa.array(owner, pa.int64()), pa.array(words, pa.string()), pa.array(times, pa.int64())], names=["_row", "_word", "_n"])

    def run_rows(batches: Batches) -> Batches:
        for batch in slices(batches, 20_000):
            words = batch.column(0)
            word, gram = longest_runs(words.to_pylist())
            yield pa.RecordBatch.from_arrays([words.take(pa.array(word)), pa.array(gram)], names=["_word", "gram"])

    used = rows.select("_row", "_text").mapInArrow(word_rows, "_row long, _word string, _n long")
    used = stored(used, "toxicity-used")
    each = used.select("_word").distinct().mapInArrow(run_rows, "_word string, gram long").join(runs.select("gram", F.col(ratio).alias("_r")), "gram", "left")
    mean = (F.coalesce(F.sum("_r"), F.lit(0.0)) / F.count("*")).alias("_mean")  # as many runs as letters, with the end mark
    scores = each.groupBy("_word").agg(mean, F.coalesce(F.sum("_r"), F.lit(0.0)).alias("_whole"))

    def highest(c: str, n: int = 3) -> Column:
        all_of = F.flatten(F.collect_list(F.array_repeat(F.col(c), F.least(F.col("_n"), F.lit(n)).cast("int"))))
        return F.slice(F.concat(F.slice(F.sort_array(all_of, asc=False), 1, n), F.array_repeat(F.lit(0.0), n)), 1, n)

    total = F.sum("_n").cast("double")
    x = F.concat(F.array(F.sum(F.col("_n") * F.col("_mean")) / total, F.log1p(total)), highest("_mean"), highest("_whole"))
    return used.join(scores, "_word").groupBy("_row").agg(x.alias("_x"))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, spread and weights (intercept last) of a logistic curve, by Newton steps."""
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread == 0] = 1
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return mean, spread, w


def fold(doc_id: Column) -> Column:
    """Which third a row belongs to; 1 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


#: Models of this Python worker, by the key of their run.
_MODELS: dict[str, Scorer] = {}


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", toxic: str = "toxic", fit_rows: int = FIT_ROWS, broadcast_runs: int = BROADCAST_RUNS, out: str = "toxicity"
) -> DataFrame:
    """``docs`` with ``out double``, learnt from the rows of ``labels`` that are not held out.

    Class counts come from all of these rows, the shared counts from all documents. The curve is fitted
    on rows of fold 2, with words as they look to counts from fold 0 alone: in documents those counts
    have not seen. The scores then come from the counts of both folds. A column of that name is
    replaced.
    """
    spark = docs.sparkSession
    taught = F.col(id_col).isNotNull() & F.col(toxic).isin(0, 1) & (fold(F.col(id_col)) != 1)
    labelled = labels.where(taught).select(F.col(id_col).alias("_id"), F.col(toxic).cast("int").alias("_mark"))
    marks = labelled.groupBy("_id").agg(F.count_if(F.col("_mark") == 0).alias("_ordinary"), F.count_if(F.col("_mark") == 1).alias("_toxic"))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    words = stored(word_counts(texts, marks), "toxicity-words")
    grams = stored(gram_counts(words), "toxicity-grams")
    runs = stored(run_ratios(grams), "toxicity-runs")
    curve = labelled.where(fold(F.col("_id")) == 2)
    share = min(1.0, 0.99 * fit_rows / max(1, curve.count()))
    curve = curve.where(F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(1_000_000)) < F.lit(share * 1_000_000)).limit(fit_rows)
    curve = F.broadcast(stored(curve, "toxicity-curve"))
    sample = texts.join(curve, "_id").select("_text", "_mark")
    if runs.count() > broadcast_runs:
        return _scored_by_joins(docs, text, sample, runs, out)
    table = runs.toArrow().sort_by("gram")
    shared = spark.sparkContext.broadcast([table.column(c).to_numpy() for c in ("gram", "whole", "fit")])
    run_key = uuid.uuid4().hex

    def model(ratio: int) -> Scorer:
        key = f"{run_key} {ratio}"
        if key not in _MODELS:
            _MODELS.clear()
            _MODELS[key] = Scorer(shared.value[0], shared.value[ratio])
        return _MODELS[key]

    def features(batches: Batches) -> Batches:
        for batch in slices(batches):
            x = model(2).features(texts_of(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), batch.column(1)], names=["x", "y"])

    probability = _fitted(sample.mapInArrow(features, "x array<double>, y int").toPandas())

    @F.pandas_udf("double")
    def scored(column: pd.Series) -> pd.Series:
        out = [probability(model(1).features([t or "" for t in column.iloc[at : at + 500]])) for at in range(0, len(column), 500)]
        return pd.Series(np.concatenate(out) if out else np.zeros(0), dtype=float)

    return docs.withColumn(out, scored(F.col(text)))


def _fitted(rows: pd.DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """The curve by ``x`` and ``y``, as a function of features."""
    if len(rows):
        mean, spread, weights = fit_logistic(np.vstack(rows["x"]), rows["y"].to_numpy(float))
    else:
        mean, spread, weights = np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES + 1)
    return lambda x: 1 / (1 + np.exp(-np.clip(((x - mean) / spread) @ weights[:-1] + weights[-1], -50, 50)))


def _scored_by_joins(docs: DataFrame, text: str, sample: DataFrame, runs: DataFrame, out: str) -> DataFrame:
    nothing = F.array_repeat(F.lit(0.0), FEATURES)

    def described(df: DataFrame, ratio: str) -> DataFrame:
        """``_row, _x`` of the rows of ``df (_row, _text)``."""
        return df.select("_row").join(joined_features(df, runs, ratio), "_row", "left").select("_row", F.coalesce("_x", nothing).alias("_x"))

    taught = stored(sample.withColumn("_row", F.monotonically_increasing_id()), "toxicity-rows")
    fitted = described(taught, "fit").join(taught.select("_row", "_mark"), "_row")
    probability = _fitted(fitted.select(F.col("_x").alias("x"), F.col("_mark").alias("y")).toPandas())

    @F.pandas_udf("double")
    def scored(column: pd.Series) -> pd.Series:
        return pd.Series(probability(np.vstack(column)) if len(column) else np.zeros(0), dtype=float)

    row = unused(docs, "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "toxicity-rows")
    found = described(rows.select(F.col(row).alias("_row"), F.col(text).alias("_text")), "whole")
    scores = found.select(F.col("_row").alias(row), scored("_x").alias(unused(docs, "score")))
    joined = rows.join(scores, row).withColumn(out, F.col(unused(docs, "score")))
    return joined.select(*docs.columns, *([] if out in docs.columns else [out]))
