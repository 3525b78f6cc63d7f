"""Hard negatives against a comparison with all rows; the curve, the bounds and what they spare."""

import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from trueledger.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(data, is_anchor, positives=5, negatives=3, low=50, high=95):
    valid = [(i, [math.floor(256 * float(np.float32(c))) for c in x], label) for i, x, label in data if i is not None and x is not None and label is not None and all(c is not None and math.isfinite(c) for c in x)]
    out = []
    for i, x, label in valid:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(map(int.__mul__, x, y)), j, other) for j, y, other in valid if len(x) == len(y))
        for p, j, _ in [s for s in scored if s[2] == label and s[1] != i][:positives]:
            fits = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:negatives]
            out += [(i, j, r, k, -p, -s) for r, (s, k, _) in enumerate(fits, 1)]
    return sorted(out, key=repr)


def vectors(n, d, seed, spread=0.3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, d))
    label = draw.integers(0, 6, n)
    return [(i, (centres[c] * 0.4 + spread * draw.normal(size=d)).astype(np.float32).tolist(), int(c if i % 3 else (c + 1) % 6)) for i, c in enumerate(label.tolist())]


@pytest.fixture
def small(monkeypatch):
    """Blocks, groups and pages so small that every search meets many of them."""
    monkeypatch.setattr(hn, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hn, "GROUP_ROWS", 16)
    monkeypatch.setattr(hn, "PAGE_BLOCKS", 3)


def odd():
    nan, inf = float("nan"), float("inf")
    same = [0.5, 0.25, -0.5, 0.0]
    data = [(i, same, i % 2) for i in range(0, 40)]  # ties everywhere
    data += [(100, None, 1), (101, [nan, 0.0, 0.0, 0.0], 1), (102, [inf, 0.0, 0.0, 0.0], 0), (103, [None, 1.0, 1.0, 1.0], 0), (104, same, None), (None, same, 1)]
    data += [(150, same, 0), (150, same, 0), (151, same, 0), (151, same, 0), (151, same, 1)]  # repeated rows
    data += [(200 + i, [0.1 * i, 0.5], i % 3) for i in range(12)]  # another length
    data += [(250, [], 1), (251, [], 1), (252, [], 0), (300, [0.0] * 4, 5), (350, [-0.5, -0.25, 0.5, 0.0], 1), (400, [0.001, -0.001, 0.4, 9.0], 7)]
    return data


def test_odd_vectors_as_defined(spark, small):
    found = hn.mine(spark.createDataFrame(odd(), SCHEMA), F.col("vec_id") % 50 == 0)
    assert rows(found) == plain(odd(), lambda i: i % 50 == 0)


def test_many_vectors_as_defined(spark, small):
    data = vectors(900, 12, 4)
    found = hn.mine(spark.createDataFrame(data, SCHEMA).repartition(3), F.col("vec_id") % 20 == 0)
    assert rows(found) == plain(data, lambda i: i % 20 == 0)


def test_other_numbers_and_names(spark, small):
    data = vectors(200, 5, 9)
    df = spark.createDataFrame(data, "page long, unit array<double>, n int").withColumns({"label": F.lit("x"), "kind": F.lit(3), "d": F.lit(None), "windows": F.lit("")})
    found = hn.mine(df, F.col("page") % 10 == 0, id="page", vector="unit", label="n", positives=2, negatives=4, low_percent=10, high_percent=100)
    want = sorted(r for r in plain_with(data))
    assert sorted(map(tuple, found.collect())) == want


def plain_with(data):
    out = []
    q = [(i, [math.floor(256 * c) for c in x], label) for i, x, label in data]
    for i, x, label in q:
        if i % 10:
            continue
        scored = sorted((-sum(map(int.__mul__, x, y)), j, other) for j, y, other in q)
        for p, j, _ in [s for s in scored if s[2] == label and s[1] != i][:2]:
            fits = [s for s in scored if s[2] != label and 10 * -p <= 100 * -s[0] <= 100 * -p][:4]
            out += [(i, j, r, k, -p, -s) for r, (s, k, _) in enumerate(fits, 1)]
    return out


def test_empty_table_and_no_anchor(spark):
    assert hn.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
    assert hn.mine(spark.createDataFrame([(1, [1.0], 0)], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0


def test_scores_beyond_a_long_raise(spark):
    with pytest.raises(PySparkException):
        hn.mine(spark.createDataFrame([(50, [3e30, 1.0], 0)], SCHEMA), F.col("vec_id") % 50 == 0).count()


def test_products_are_exact_when_doubles_are_not():
    draw = random.Random(1)
    a, b = (np.array([[draw.randint(-(2**30), 2**30) for _ in range(3)] for _ in range(20)], np.int32) for _ in range(2))
    want = [[sum(x * y for x, y in zip(r, s, strict=True)) for s in b.tolist()] for r in a.tolist()]
    assert hn.product(a, b).tolist() == want


def test_curve_visits_neighbours():
    n, bits = 3, 3
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
    keys = hn.hilbert_keys(grid, bits)
    assert sorted(keys.tolist()) == list(range(1 << (n * bits)))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_bounds_hold_and_spare_blocks(spark, small):
    """Tight clusters: the second round reads a small part of what the anchors could meet."""
    data = vectors(1_500, 6, 2, spread=0.02)
    df = hn.ordered(hn.whole_vectors(spark.createDataFrame(data, SCHEMA), "vec_id", "embedding", "label", 256, F.col("vec_id") % 50 == 0))
    blocks = hn.cut(df, 16).collect()
    anchors = np.stack([np.frombuffer(r["q"], "<i4") for r in df.where("anchor").collect()])
    asked = met = 0
    for block in blocks:
        x = np.frombuffer(block["q"], "<i4").reshape(block["n"], block["d"])
        lo, hi = (np.frombuffer(block[c], "<i4")[None, :] for c in ("lo", "hi"))
        low, high = hn.bounds(anchors, lo, hi)
        scores = hn.product(anchors, x)
        assert (scores >= low).all() and (scores <= high).all()
        asked, met = asked + len(anchors), met + int((high[:, 0] >= np.sort(hn.product(anchors, anchors), 1)[:, -6]).sum())
    assert met < asked / 2
