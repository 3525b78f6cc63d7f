"""Vectors of every length are compared, with those of their length alone."""

from conftest import rows

from trueledger.llm import vectors


def test_each_length_by_itself(spark, monkeypatch):
    data = [(1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [0.99, 0.05, 0.0]), (4, [0.0, 1.0, 0.0])]
    data += [(10 + i, [float(i == j) for j in range(8)]) for i in range(6)] + [(20, [1.0] + [0.01] * 7)]
    data += [(30, [2.0]), (31, [5.0]), (32, [-1.0]), (40, None), (41, []), (42, [0.0, 0.0]), (43, [0.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    want = {1: (2, 1), 2: (2, 1), 3: (2, 1), 10: (1, 10), 20: (1, 10), 30: (1, 30), 31: (1, 30)}
    for block in (1024, 2):  # in one pass, and each length by an index of its own
        monkeypatch.setattr(vectors, "BLOCK", block)
        found = rows(vectors.near_duplicates(df).select("id", "n_links", "component_id", "kept"))
        assert found == sorted(((i, *want.get(i, (0, i)), want.get(i, (0, i))[1] == i) for i, _ in data), key=repr)
