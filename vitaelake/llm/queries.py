"""The registered queries of this subpackage and their SQL."""

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import vitaelake
from vitaelake.llm import (
    chat_quotes,
    decontamination,
    embedding_whitening,
    fingerprints,
    html_blocks,
    ngram_join,
    orc_tokens,
    packing,
    quality_rules,
    quality_trees,
    spelling_variants,
    suffix_dedup,
    toxicity,
)
from vitaelake.session import scratch_location, ship_packages

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that gives the same rows where there is one."""

    def register(function: Query) -> Query:
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_packages(spark, vitaelake)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_benchmark_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document and the test item it contains, with the stretch that agrees."""
    found = decontamination.overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.drop("digest").distinct()


QUALITY_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
grams AS (
  SELECT doc_id, i, list_aggregate(w[i:i+4], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
starts AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams)
  WHERE n > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM starts, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id),
base AS (
  SELECT d.doc_id, source, text, l, len(w) AS n_words,
         length(list_aggregate(list_concat([''], w), 'string_agg', '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words
  FROM d LEFT JOIN repeats r ON d.doc_id = r.doc_id),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base),
lines AS (
  SELECT DISTINCT doc_id, source, text, regexp_replace(translate(trim(regexp_replace(
           x, '[\x20\x09-\x0D]+', ' ', 'g'), ' '),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g') AS line
  FROM (SELECT doc_id, source, text, unnest(l) AS x FROM judged)),
frequent AS (
  SELECT source, line FROM lines GROUP BY source, line HAVING count(DISTINCT text) > 100),
lost AS (
  SELECT doc_id, sum(length(lines.line)) AS total,
         sum(CASE WHEN f.line IS NULL THEN 0 ELSE length(lines.line) END) AS lost,
         count(f.line) AS n
  FROM lines LEFT JOIN frequent f
    ON lines.line = f.line AND lines.source IS NOT DISTINCT FROM f.source
  GROUP BY doc_id)
SELECT j.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       CAST(coalesce(lost.n, 0) AS BIGINT) AS lost_lines,
       CAST(coalesce(lost.lost, 0) AS BIGINT) AS lost_chars,
       NOT base_failed AND (coalesce(lost.total, 0) - coalesce(lost.lost, 0))
         >= 0.3 * coalesce(lost.total, 0) AS kept
FROM judged j LEFT JOIN lost ON j.doc_id = lost.doc_id
"""


@query("op10_quality_rules", QUALITY_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


@query("op5_cost_balanced_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in the sequences."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file())


@query("op8_orc_token_ids")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written as ORC and read back."""
    location = scratch_location(spark, "orc-tokens")
    orc_tokens.write_documents(table(spark, sf_dir, "documents"), location, tokenizer_file())
    return orc_tokens.document_places(spark, location)


@query("op9_ngram_jaccard_join")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of alike 3-word shingle sets."""
    return ngram_join.components(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id"
    )


@query("op7_suffix_array_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages that start earlier."""
    cut = suffix_dedup.cut_documents(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.score_toxicity(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query("op6_quality_trees")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_trees.score_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query("op4_quotation_linking")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message with the one it replies to, its thread, and its text without quotes."""
    return chat_quotes.link_quotes(table(spark, sf_dir, "conversations"))


@query("op3_html_extraction")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_blocks.extract(table(spark, sf_dir, "pages"))


@query("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word with the far commoner one it is an edit away from."""
    words = spelling_variants.word_counts(table(spark, sf_dir, "documents"), thinned=31)
    return spelling_variants.group_variants(words)


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's whitened components."""
    return embedding_whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op13_document_fingerprints")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of its edited copy, and how alike they are."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))
