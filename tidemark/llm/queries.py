"""The queries opN_<name>: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers

from tidemark.llm import op01_sharding, op02_simhash, op03_exact, op04_tokens, op05_quality, op06_licenses, op07_bpe, op08_packing, op09_media
from tidemark.llm import op10_lines as line_dedup
from tidemark.llm import op11_minhash as minhash
from tidemark.llm import op12_alignment as alignment
from tidemark.llm import op13_spelling as spelling

BYTE_VOCABULARY, WORD_VOCABULARY = (public_tokenizers.path(f"{name}.json") for name in ("byte_bpe_50k", "word_bpe_49k"))

PIECE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op01_sharding.shard(_table(spark, sf_dir, "documents"), 16)


def op3_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op03_exact.deduplicate(_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op02_simhash.near_duplicates(_table(spark, sf_dir, "documents"), words_a_shingle=4, max_distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp0"), 16, "0")).alias("fingerprint"), "component_id")


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op04_tokens.count_tokens(_table(spark, sf_dir, "documents"), PIECE_VOCABULARY)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = op05_quality.fit(docs, _table(spark, sf_dir, "labels"))
    return op05_quality.score(docs, model).select(
        "doc_id", op05_quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op06_licenses.scan(_table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op07_bpe.round_trip(_table(spark, sf_dir, "documents"), BYTE_VOCABULARY, digests=True)
    return found.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08_packing.pack(_table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of each text are its recording: the tables have no audio of their own."""
    return op09_media.align(_table(spark, sf_dir, "documents"), F.col("doc_id"), F.encode("text", "UTF-8")).withColumnRenamed("id", "doc_id")


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(_table(spark, sf_dir, "documents"), dropped="n_dropped")
    return cleaned.select("doc_id", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words_a_shingle=5, similarity=0.85)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups are told as a1,a2|b1;a3|b2,b3."""
    return alignment.align(_table(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_MODEL, separators=("|", ";"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding, op2_simhash, op3_exact, op4_tokens, op5_quality, op6_licenses, op7_bpe, op8_packing, op9_media, op10_lines, op11_minhash, op12_alignment, op13_spelling,
        pipeline,
    )
}

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_sharding"] = op01_sharding.reference_sql()

ORACLE_SQL["op3_exact"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLE_SQL["op10_lines"] = """
WITH split AS (SELECT doc_id, text, coalesce(source, '') AS host, string_split(text, chr(10)) AS lines FROM documents),
totals AS (SELECT host, count(*) AS pages FROM split GROUP BY host),
counted AS (SELECT host, unnest(list_distinct(list_filter(lines, lambda x: trim(x) <> ''))) AS line FROM split),
frequent AS (
    SELECT host, line FROM counted JOIN totals USING (host) GROUP BY host, line, pages HAVING count(*) >= 5 AND count(*) > 0.06::DOUBLE * pages
),
frames AS (SELECT host, list(line) AS frame FROM frequent GROUP BY host),
cut AS (SELECT doc_id, text, lines, list_filter(lines, lambda x: NOT coalesce(list_contains(frame, x), false)) AS rest FROM split LEFT JOIN frames USING (host)),
acted AS (SELECT *, len(list_filter(rest, lambda x: trim(x) <> '')) > 0 AS acts FROM cut)
SELECT doc_id, CASE WHEN acts THEN len(lines) - len(rest) ELSE 0 END AS n_dropped,
       sha256(coalesce(CASE WHEN acts THEN array_to_string(rest, chr(10)) ELSE text END, '')) AS text_sha256
FROM acted
"""

ORACLE_SQL["op6_licenses"] = op06_licenses.reference_sql()

#: Sets and their intersections, not signatures; what is reachable is found by ever smaller ids along links.
ORACLE_SQL["op11_minhash"] = """
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' '))) END AS own
    FROM worded
),
classes AS (SELECT own, min(doc_id) AS node FROM (SELECT doc_id, list_sort(own) AS own FROM sets WHERE len(own) > 0) GROUP BY own),
told AS (SELECT node, len(own) AS n, unnest(own) AS shingle FROM classes),
met AS (SELECT x.node AS a, y.node AS b, x.n AS n_a, y.n AS n_b, count(*) AS common FROM told x JOIN told y ON x.shingle = y.shingle AND x.node < y.node GROUP BY ALL),
links AS (SELECT a, b FROM met WHERE 100 * common >= 85 * (n_a + n_b - common)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, other) AS (SELECT node, node FROM classes UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a),
least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
named AS (SELECT list_sort(own) AS own, doc_id FROM sets)
SELECT named.doc_id, len(named.own) AS n_shingles, coalesce(component_id, named.doc_id) AS component_id, named.doc_id = coalesce(component_id, named.doc_id) AS kept
FROM named LEFT JOIN classes ON named.own = classes.own LEFT JOIN least USING (node)
"""
