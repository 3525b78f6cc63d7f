"""One document of each group of near duplicates stays, whatever their ids."""

import random

import corpus_pipeline


def test_groups_without_or_with_repeated_ids(spark, folder):
    rng = random.Random(4)
    text = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(120))
    a, b, c, d = text(), text(), text(), text()
    rows = [(None, a), (None, a + " end"), (None, b), (None, b + " end"), (5, c), (5, c + " end"), (None, d), (7, d + " end"), (8, text())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.one_of_each_group(spark, docs, folder).collect()
    assert [sum(r.text in (t, t + " end") for r in left) for t in (a, b, c, d)] == [1, 1, 1, 1]
    assert (7, d + " end") in [tuple(r) for r in left] and len(left) == 5
