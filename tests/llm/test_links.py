"""Line dedup, the n-gram join and vector search against comparing everything with everything."""

import random
from collections import defaultdict

import numpy as np
import pytest
from conftest import rows
from llm.conftest import odd_documents
from pyspark.sql import functions as F

from trueledger.llm import chosen_path, line_dedup, vectors
from trueledger.llm.common import stored
from trueledger.llm.components import components, forest


def closure(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100, i) for i in range(101, 160)] + [(i, i + 1) for i in range(200, 240)]
    want = closure({n for p in pairs for n in p if p[0] != p[1]}, [p for p in pairs if p[0] != p[1]])
    got = dict(rows(components(spark.createDataFrame(pairs, "a long, b long"))))
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest():
    rng = np.random.default_rng(3)
    link = rng.random((40, 40)) < 0.03
    link |= link.T
    want = closure(range(40), zip(*np.nonzero(link)))
    assert forest(link).tolist() == [want[i] for i in range(40)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, text, times):
    s = list(text)
    for _ in range(times):
        at, kind = rng.randrange(len(s)), rng.choice("ids")
        if kind == "i":
            s.insert(at, rng.choice("abé"))
        elif kind == "d" and len(s) > 8:
            s.pop(at)
        else:
            s[at] = rng.choice("abé")
    return "".join(s)


@pytest.mark.parametrize("most", [1, 2, 3])
def test_bit_parallel_distance(spark, most):
    rng, data = random.Random(most), []
    while len(data) < 300:
        a = "".join(rng.choice("abé") for _ in range(rng.randint(9, 40)))
        b = changed(rng, a, rng.randint(0, most + 3))
        if abs(len(a) - len(b)) <= most:
            data.append((a, b))
    df = spark.createDataFrame(data, "line_a string, line_b string")
    got = df.withColumn("d", line_dedup.bit_parallel_distance(F.col("line_a"), F.col("line_b"), most)).collect()
    assert all(min(r.d, most + 1) == min(edits(r.line_a, r.line_b), most + 1) for r in got)
    assert rows(line_dedup.verified(df, most)) == sorted((p for p in data if edits(*p) <= most), key=repr)


def test_long_lines_are_verified(spark):
    rng, data = random.Random(8), []
    for _ in range(60):
        a = "".join(rng.choice("abcdé fgh") for _ in range(rng.randint(150, 400)))
        data.append((a, changed(rng, a, rng.randint(0, 4))))
    df = spark.createDataFrame([p for p in data if abs(len(p[0]) - len(p[1])) <= 2], "line_a string, line_b string")
    assert rows(line_dedup.verified(df, 2)) == sorted((p for p in data if edits(*p) <= 2), key=repr)


@pytest.mark.parametrize("most", [1, 2])
def test_line_links_are_complete(spark, most):
    rng, lines = random.Random(10 + most), set()
    while len(lines) < 150:
        base = "".join(rng.choice("abcdé fgh") for _ in range(rng.randint(18, 45)))
        lines |= {base, changed(rng, base, rng.randint(1, most + 1)), changed(rng, base, most)}
    lines = sorted(lines)
    df = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    want = [(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines)) if min(len(lines[i]), len(lines[j])) >= 20 and edits(lines[i], lines[j]) <= most]
    assert rows(line_dedup.links(stored(line_dedup.with_signature(df), "test-lines"), most)) == sorted(want, key=repr) and len(want) > 50


def test_repeated_lines(spark):
    a, near, far = "the first line of some length", "the first lime of some lengths", "the first lane if same length"
    df = spark.createDataFrame(
        [(2, f"{near}\nshort\n\nkept here"), (1, f"{a}\nshort\n\n{far}"), (3, a), (4, None), (5, ""), (None, f"{a}\nonly here, without an id"), (6, "shart\n ")],
        "doc_id long, text string",
    ).withColumn("at", F.lit("clash"))
    found = line_dedup.repeated(df)
    assert rows(found) == sorted([(2, 0, 1, 0), (2, 1, 1, 1), (3, 0, 1, 0), (None, 0, 1, 0)], key=repr)
    left = {(r.doc_id, r.text) for r in line_dedup.without_repeats(df, found).collect()}
    assert left == {(2, "\nkept here"), (1, f"{a}\nshort\n\n{far}"), (4, None), (5, ""), (None, "only here, without an id"), (6, "shart\n ")}
    assert line_dedup.without_repeats(df, found).columns == df.columns
    counts = {r.id: (r.n_lines, r.n_dropped) for r in line_dedup.per_document(df, found).collect()}
    assert counts == {1: (4, 0), 2: (4, 2), 3: (1, 1), 4: (0, 0), 5: (1, 0), 6: (2, 0), None: (2, 1)}
    empty = df.limit(0)
    assert line_dedup.per_document(empty, line_dedup.repeated(empty)).count() == 0
    odd = odd_documents(spark)
    assert line_dedup.per_document(odd, line_dedup.repeated(odd)).count() == odd.count()


def shingles(text):
    w = text.split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_runs_follow_the_recall():
    assert chosen_path.runs_for(0.999, 3) > chosen_path.runs_for(0.9, 3) > chosen_path.runs_for(0.9, 1)


@pytest.mark.parametrize("block", [512, 7])
def test_join_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(chosen_path, "BLOCK", block)
    rng, texts = random.Random(21), []
    for _ in range(12):
        base = [rng.choice("abcdefghij") + rng.choice("klmnop") + str(rng.randrange(40)) for _ in range(rng.randint(30, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = "new" + str(rng.randrange(9))
            texts.append(" ".join(copy))
    texts += [texts[0]] * 30 + ["", None, " ", "one two", "one  two", "one two"]
    data = [(i * 3, t) for i, t in enumerate(texts)]
    sets = [shingles(t or "") for t in texts]
    pairs = []
    for i in range(len(texts)):
        for j in range(i + 1, len(texts)):
            both = len(sets[i] & sets[j])
            if (texts[i] or "") == (texts[j] or "") or (both and both >= 0.8 * len(sets[i] | sets[j])):
                pairs.append((i, j))
    links, root = defaultdict(int), closure(range(len(texts)), pairs)
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    want = [(3 * i, links[i], 3 * root[i], root[i] == i) for i in range(len(texts))]
    got = chosen_path.join(spark.createDataFrame(data, "doc_id long, text string")).drop("key")
    assert rows(got) == sorted(want, key=repr)


def test_join_of_a_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "BLOCK", 50)
    base = [f"w{i}" for i in range(200)]
    data = [(i, " ".join([*base[:i], "x", *base[i + 1 :]])) for i in range(200)]
    got = chosen_path.join(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert all(r.n_links == 199 and r.component_id == 0 for r in got)


def test_join_odd_rows(spark):
    odd = odd_documents(spark)
    got = {(r.id, r.n_links, r.component_id) for r in chosen_path.join(odd).collect()}
    assert {(1, 2, 1), (2, 2, 1), (3, 2, 3), (4, 2, 3), (None, 2, 3), (5, 0, 5), (8, 0, 8), (None, 0, None)} <= got
    assert chosen_path.join(odd.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 24)).astype(np.float32)
    for i in range(100, 250):
        x[i] = x[i - 100] + rng.normal(size=24) * rng.choice([0.05, 0.2, 0.3])
    x[250:330] = x[0] + rng.normal(size=(80, 24)) * 0.08
    x[330:350] = x[5]
    data = [(int(i), [float(v) for v in row]) for i, row in enumerate(x)]
    data += [(400, None), (401, [0.0] * 24), (402, [float("nan")] + [1.0] * 23), (403, [None] + [1.0] * 23), (404, [1.0] * 3), (405, [float("inf")] + [1.0] * 23), (None, [float(v) for v in x[5]])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("key", F.lit("clash"))
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.95
    np.fill_diagonal(near, False)
    root = closure(range(400), zip(*np.nonzero(near)))
    got = {r.id: r for r in vectors.near_duplicates(df).collect() if r.id is not None}

    want = near.sum(1) + (near[:, 5] | (np.arange(400) == 5)).astype(int)
    found = sum(min(got[i].n_links, want[i]) for i in range(400))
    assert all(got[i].n_links <= want[i] for i in range(400)) and found >= 0.97 * want.sum()
    assert sum(got[i].component_id == root[i] for i in range(400)) >= 0.97 * 400
    for i in range(400, 406):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert vectors.near_duplicates(df.limit(0)).count() == 0
    assert rows(vectors.near_duplicates(df.where("vec_id >= 400")).select("n_links")) == [(0,)] * 6


def test_recall_on_the_given_vectors(spark, sf_dir):
    rows_ = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    x = np.array([r.embedding for r in rows_], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    got = {r.id: r.n_links for r in vectors.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).collect()}
    want = dict(zip((r.vec_id for r in rows_), near.sum(1)))
    assert all(got[v] <= want[v] for v in want) and sum(got.values()) >= 0.97 * near.sum()
