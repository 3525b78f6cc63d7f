"""The text operators as named queries over a folder of driver tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trueledger.llm import byte_bpe, chosen_path, fingerprint, hard_negatives, html_text, licences, line_dedup, packing, prefix_bpe, resampling, toxicity, vectors, warc
from trueledger.llm.common import hex_sha256

#: Score from which a document counts as toxic.
TOXIC_FROM = 0.7

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Documents are long: a thousand of them are a batch for Python, not Spark's ten thousand rows.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Components of ``links (a, b)`` over ``nodes (id)``, as one row per node: ``id, component_id``.
_COMPONENTS = """
reach(id, c) AS (
    SELECT id, id FROM nodes
    UNION
    SELECT l.a, r.c FROM reach r JOIN links l ON l.b = r.id WHERE r.c < l.a
),
component AS (SELECT id, min(c) AS component_id FROM reach GROUP BY id)
"""


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its lines that repeat an earlier one, within two edits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_dedup.per_document(docs, line_dedup.repeated(docs))
    listed = F.transform("dropped", lambda d: F.concat_ws(":", d["at"], d["first_id"], d["first_at"]))
    return found.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.array_join(listed, ",").alias("dropped"))


ORACLES["op1_line_dedup"] = f"""
WITH RECURSIVE o AS (
    SELECT doc_id, unnest(range(len(l)))::INTEGER AS place, unnest(l) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)
),
p AS (SELECT * FROM o WHERE regexp_matches(line, '\\S')),
d AS (SELECT line, length(line) AS n, row_number() OVER (ORDER BY min(row(doc_id, place))) AS id, min(row(doc_id, place)) AS head FROM p GROUP BY line),
near AS (
    SELECT x.id AS a, y.id AS b FROM d x JOIN d y ON y.n IN (x.n, x.n + 1, x.n + 2) AND x.id <> y.id
    WHERE x.n >= 20 AND y.n >= 20
      -- two edits leave one of three parts as it is
      AND (contains(y.line, left(x.line, x.n // 3)) OR contains(y.line, right(x.line, x.n // 3)) OR contains(y.line, substring(x.line, x.n // 3 + 1, x.n - 2 * (x.n // 3))))
      AND levenshtein(x.line, y.line) <= 2
),
links AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
nodes AS (SELECT id FROM d),
{_COMPONENTS},
f AS (SELECT d.line, g.head FROM d JOIN component c USING (id) JOIN d g ON g.id = c.component_id),
gone AS (
    SELECT doc_id, count(*) AS k, string_agg(place || ':' || head[1] || ':' || head[2], ',' ORDER BY place) AS dropped
    FROM p JOIN f USING (line) WHERE row(doc_id, place) <> head GROUP BY doc_id
)
SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(k, 0)::BIGINT AS n_dropped, coalesce(dropped, '') AS dropped
FROM documents LEFT JOIN gone USING (doc_id)
"""


@query
def op2_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, then read back from the archives."""
    rows = warc.with_roles(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    return warc.read(spark, warc.write(rows)).select(
        F.col("row_id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )


ORACLES["op2_warc_bundles"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY digest),
r AS (SELECT p.*, CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to FROM p LEFT JOIN f USING (digest))
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM r
"""


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN).drop("text")
    return byte_bpe.decode(coded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        hex_sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        hex_sha256(F.col("decoded")).alias("decoded_sha256"),
    )


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    docs = table(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, 2048, separator=0)
    return packing.pack(packing.with_crc32(pieces), 2048)


@query
def op8_threshold_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, beside those of its edited text and of the next document."""
    pairs = fingerprint.with_next(table(spark, sf_dir, "documents"), "doc_id", "text")
    text, following = F.coalesce("text", F.lit("")), F.coalesce("next_text", F.lit(""))
    moved = (F.length(text) / 4).cast("int")
    edited = F.concat(F.substring(text, F.lit(1), F.length(text) - moved), F.substring(following, F.lit(1), moved))
    rows = pairs.select("doc_id", F.length(text).cast("long").alias("n_chars"), text.alias("text"), edited.alias("edited"), following.alias("next_text"))
    made = fingerprint.add_fingerprints(
        rows,
        {"fingerprint": "text", "edited_fingerprint": "edited", "_next": "next_text"},
        {"near_edited": ("fingerprint", "edited_fingerprint"), "near_next": ("fingerprint", "_next")},
    )
    return made.select("doc_id", "n_chars", hex_sha256(F.col("edited")).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query
def op7_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        F.coalesce(toxicity.fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


@query
def op6_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's near duplicates."""
    found = vectors.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


ORACLES["op6_product_quantisation"] = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
      AND len(list_filter(embedding, lambda e: e <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.x, b.x) >= 0.95
),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_COMPONENTS},
n AS (SELECT a AS id, count(*) AS n_links FROM links GROUP BY a)
SELECT id AS vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, id = component_id AS kept
FROM component LEFT JOIN n USING (id)
"""


@query
def op10_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near duplicates on runs of five words."""
    found = chosen_path.join(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_links", "component_id", "kept")


ORACLES["op10_chosen_path_join"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT text, min(doc_id) AS rep, list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '') AS w FROM d GROUP BY text),
s AS (
    SELECT rep, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS shingle
    FROM t
),
size AS (SELECT rep, count(*) AS n FROM s GROUP BY rep),
near AS (
    SELECT x.rep AS a, y.rep AS b FROM s x JOIN s y ON x.shingle = y.shingle AND x.rep <> y.rep
    GROUP BY x.rep, y.rep
    HAVING count(*) >= 0.8 * ((SELECT n FROM size WHERE rep = x.rep) + (SELECT n FROM size WHERE rep = y.rep) - count(*))
),
class AS (SELECT a AS ra, b AS rb FROM near UNION ALL SELECT rep, rep FROM t),
member AS (SELECT doc_id, rep FROM d JOIN t USING (text)),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM class JOIN member x ON x.rep = ra JOIN member y ON y.rep = rb WHERE x.doc_id <> y.doc_id),
nodes AS (SELECT doc_id AS id FROM d),
{_COMPONENTS},
n AS (SELECT a AS id, count(*) AS n_links FROM links GROUP BY a)
SELECT id AS doc_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, id = component_id AS kept
FROM component LEFT JOIN n USING (id)
"""


@query
def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the licences it states."""
    found = licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    listed = F.transform("licences", lambda m: F.concat_ws(":", m["licence"], m["start"], m["words"], F.round(m["likeness"], 6)))
    return found.select(
        "doc_id",
        F.size("licences").cast("long").alias("n_passages"),
        F.array_join(F.array_sort(F.array_distinct("licences.licence")), ",").alias("licences"),
        F.array_join(listed, ",").alias("passages"),
    )


@query
def op9_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_text.extract(pages, html_text.templates(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its weight towards the benchmark; a tenth of those with 20 words is drawn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = resampling.scored(docs, table(spark, sf_dir, "benchmark")).drop("text")
    return resampling.draw(found, 10, eligible=F.col("n_words") >= 20).select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 of the UTF-8 bytes in hex ``h``, by the usual table of 256 entries, made from its rule.
_CRC32 = """
steps AS (SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS c FROM steps WHERE k = 8),
"""

ORACLES["op11_importance_resampling"] = f"""
WITH RECURSIVE {_CRC32}
texts AS (
    SELECT 'd' AS side, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
    UNION ALL SELECT 't', item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
),
words AS (SELECT side, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
counted AS (SELECT side, doc_id, word, count(*) AS n FROM words GROUP BY ALL),
hashed AS (
    SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(word) + 1), lambda j: ('0x' || substring(hex(encode(word)), 2 * j - 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t.c[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 10000 AS cell
    FROM (SELECT DISTINCT word FROM counted), crc_table t
),
cells AS (SELECT cell, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 't'), 0)::DOUBLE AS t FROM counted JOIN hashed USING (word) GROUP BY cell),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM cells),
gain AS (SELECT cell, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM cells, totals),
weighed AS (
    SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
    FROM counted JOIN hashed USING (word) JOIN gain USING (cell) WHERE side = 'd' GROUP BY doc_id
),
scored AS (
    SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
    FROM documents LEFT JOIN weighed USING (doc_id)
),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 10 * count(*) OVER () // 100 AS k FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= k THEN rank END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""


@query
def op12_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded as the tokenizers library does, and decoded again."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = prefix_bpe.encode(docs, path, public_tokenizers.PATTERN).drop("text")
    return prefix_bpe.decode(coded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        hex_sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        hex_sha256(F.col("decoded").cast("binary")).alias("decoded_sha256"),
    )


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each anchor's positives, the best negatives between half and 95 hundredths of their score."""
    id, label = F.col("vec_id"), F.col("label")
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(id % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(rows, id % 50 == 0)


ORACLES["op13_hard_negatives"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE a.vec_id % 50 = 0
),
positive AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
