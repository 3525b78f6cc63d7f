"""The pipeline's stages on a small corpus with planted cases."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from trueledger.llm.common import stored


def corpus(spark, folder):
    rng = random.Random(3)
    words = [a + b for a in "bcdfghklmn" for b in ("an", "or", "ile", "und", "est")]
    text = lambda n: "\n".join(" ".join(rng.choice(words) for _ in range(n)) for _ in range(3))
    data, marks = [], []
    for i in range(400):
        t = text(30)
        if i % 8 == 0:
            t += " " + " ".join(rng.choice(["vile", "nasty"]) for _ in range(3))
        data.append((i, t))
        marks.append((i, 1, int(i % 8 == 0)))
    copy = data[1][1]
    data += [(400, copy), (401, copy.replace("\n", " ", 1) + " end"), (402, None), (403, "")]
    data += [(403, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs


def test_stages(spark, folder):
    docs = corpus(spark, folder)
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], folder), name))
    for df in seen[1:-1]:
        assert df.columns == docs.columns
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in seen]
    toxic = {i for i in range(0, 400, 8)}
    assert len(ids[1] & toxic) <= 2 and len((ids[0] - ids[1]) - toxic) <= 4
    assert 400 not in ids[2] and {1, 401, 402, 403} <= ids[2]
    assert 401 not in ids[3] and len(ids[2] - ids[3]) == 2 and seen[3].where("doc_id = 403 OR doc_id = 402").count() == 1
    assert ids[4] == ids[3]
    assert seen[2].where(F.col("n_chars") != F.length("text")).count() == 0
    per_doc = seen[4].groupBy("doc_id").agg(F.sum("length").alias("n"))
    assert per_doc.count() == len(ids[3]) and corpus_pipeline.run(spark, folder).count() == seen[4].count()


CLASH = ("toxicity", "_toxicity", "_id", "_gone", "_kept", "_key", "_pick", "_host", "_slots", "ids", "_row", "_text", "_x", "key", "n", "dotted.name")


def test_columns_that_clash_pass_as_they_are(spark, folder):
    docs = corpus(spark, folder)
    wide = docs.select("*", *[F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(c) for c in CLASH])
    narrow, seen = docs, wide
    for name, stage in corpus_pipeline.STAGES[:-1]:
        narrow, seen = stored(stage(spark, narrow, folder), name), stored(stage(spark, seen, folder), name)
        assert seen.columns == wide.columns and [f.dataType for f in seen.schema] == [f.dataType for f in wide.schema]
        assert sorted(map(tuple, seen.select(*docs.columns).collect()), key=repr) == sorted(map(tuple, narrow.collect()), key=repr)
        assert seen.where(" OR ".join(f"`{c}` <> concat('{c} ', doc_id)" for c in CLASH)).count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    pieces = [last(spark, df, folder).select("doc_id", "piece", "start", "length", "ids_crc32") for df in (narrow, seen)]
    assert sorted(map(tuple, pieces[0].collect()), key=repr) == sorted(map(tuple, pieces[1].collect()), key=repr)


def test_no_documents(spark, folder):
    docs = corpus(spark, folder).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), name)
        assert docs.count() == 0


def test_repeated_lines_go_as_a_plain_version_drops_them(spark):
    """Very many repeats in one text, beside a plain version of the stage."""
    lines = [f"line number {i % 70} of the text that repeats" for i in range(20_000)] + ["", "  ", "short"] * 50
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines[:80] + ["a line of its own that is long"])), (3, None), (4, "short\nshort")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    # Numbers that differ in one or two digits are within two edits, so all numbered lines are one group.
    left = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, docs, "").collect()}
    assert left == {1: "\n".join([lines[0]] + ["", "  ", "short"] + ["", "  "] * 49), 2: "a line of its own that is long", 3: None}
