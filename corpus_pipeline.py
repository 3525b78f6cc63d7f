"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)``, works on all documents that the one before it kept, and
returns a DataFrame that is written to the shared folder and read again as the next stage's documents.
All but the last return the columns of ``documents``; further columns are passed on as they are, whatever
their names. Null and empty texts and repeated rows are documents like others; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trueledger.llm import chosen_path, line_dedup, packing, queries, toxicity
from trueledger.llm.common import stored, text_key, unused


def named(docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` as they are called, dots and all."""
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not found toxic."""
    score = unused(docs, "toxicity")
    scored = toxicity.score(docs, queries.table(spark, sf_dir, "labels"), out=score)
    return scored.where(F.col(score) < queries.TOXIC_FROM).select(*named(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that repeat an earlier one; those that lose every line go."""
    found = stored(line_dedup.repeated(docs), "repeated-lines")
    return line_dedup.without_repeats(docs, found).withColumn("n_chars", F.length("text").cast("long")).select(*named(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates; of repeated rows one stays."""
    id, key = unused(docs, "id"), unused(docs, "key")
    text_of = lambda id_col: F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    # Named by id, null last, and text, so that null and repeated ids leave one document of a group as well.
    pick = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("doc_id"), text_key(F.col("text")))
    picked = docs.select("text", pick.alias("pick"))
    kept = chosen_path.join(picked, "pick").where("kept").select(text_of("id.doc_id").alias(id), F.col("key").alias(key)).distinct()
    # Joined and made unique by the same two columns: the documents move once.
    keyed = docs.withColumns({id: text_of("doc_id"), key: text_key(F.col("text"))})
    return keyed.join(kept, [id, key], "left_semi").dropDuplicates([id, key]).select(*named(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, as pieces of sequences of 2048 tokens."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, 2048, separator=0)
    return packing.pack(packing.with_crc32(pieces), 2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", one_of_each_group),
    ("packing", packed),
]

#: SQL cannot express the trained and the packing stages; a test runs the stages beside plain versions of them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
