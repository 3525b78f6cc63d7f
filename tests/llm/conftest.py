import pytest

from trueledger.llm import queries


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return queries.table(spark, sf_dir, "documents")


def odd_documents(spark):
    """Nulls, empty and blank texts, repeated rows and ids, ties, and a column that clashes with internal names."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [
        (1, "one two three four five six seven", "a"),
        (1, "one two three four five six seven", "a"),
        (2, "one two three four five six seven", None),
        (3, None, "b"),
        (4, "", "b"),
        (5, " \n\t ", "b"),
        (None, "a text without an id that is long enough", "c"),
        (None, None, None),
        (6, long, "d"),
        (7, "é日本語 \U0001f600 <|endoftext|> it's  two  spaces \x1c\x85", "e"),
        (7, "another text with an id that is there twice", "e"),
        (8, "x", "f"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, key string").withColumn("ids", __import__("pyspark").sql.functions.lit("clash"))
