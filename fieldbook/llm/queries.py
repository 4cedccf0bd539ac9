"""Registered queries of the operators, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.llm import bpe, hnsw, htmlmain, infill, jaccard, langid, linededup, quality, substring, suffixtree, tokenmap, urltree, winnow
from fieldbook.llm.oracle import SQL

VOCABULARY = "byte_bpe_50k.tiktoken"
VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
RULES = [
    urltree.Rule("com", "/", "allow"),
    urltree.Rule("example.com", "/en/", "block"),
    urltree.Rule("www.example.com", "/en/", "allow"),
    urltree.Rule("net", "/es/", "block"),
    urltree.Rule("net", "/fr/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Every text encoded by the public ranks and decoded again."""
    ranks = bpe.load_ranks(public_tokenizers.path(vocabulary))
    coded = bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that stand in several documents."""
    return substring.repeated_passages(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, similarity 0.85: component of every document."""
    found = jaccard.jaccard_components(_table(spark, sf_dir, "documents"), k=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url by rule or template."""
    return urltree.judge_urls(_table(spark, sf_dir, "pages"), RULES)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 13 words in every document."""
    found = winnow.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two thirds of the labelled ones."""
    docs = _table(spark, sf_dir, "documents")
    net = langid.learn(docs)
    rows = docs.select("doc_id", "text", langid.held_out(F.col("doc_id")).alias("held_out"))
    return langid.tag(rows, net).select("doc_id", "held_out", "lang_pred", "score")


def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = _table(spark, sf_dir, "pages")
    return htmlmain.extract(pages, htmlmain.learn(pages))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth vector."""
    return hnsw.nearest(_table(spark, sf_dir, "embeddings"), every=50, k=5)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's probability, learned from four fifths of the documents."""
    return suffixtree.scores(_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 20 code points and more in three documents and more stay in the last one only."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


def op11_cross_tokenizer(spark: SparkSession, sf_dir: str, a: str = VOCABULARY_A, b: str = VOCABULARY_B) -> DataFrame:
    """Every text by two public tokenizers, aligned."""
    return tokenmap.align(_table(spark, sf_dir, "documents"), tokenmap.load(public_tokenizers.path(a), public_tokenizers.path(b)))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text cut and put together for fill-in-middle training, and restored."""
    return infill.fill_in_middle(_table(spark, sf_dir, "documents"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from two thirds of the labelled ones."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.learn(docs, _table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", "text", quality.held_out(F.col("doc_id")).alias("held_out"))
    return quality.score(rows, model).select("doc_id", "held_out", "score", "predicted")


_ALL = (
    op1_byte_bpe, op2_substring_dedup, op3_ngram_jaccard, op4_url_filter, op5_decontamination, op6_language_id, op7_html_main_text,
    op8_nearest_neighbours, op9_lm_score, op10_line_dedup, op11_cross_tokenizer, op12_fill_in_middle, op13_quality,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLE: dict[str, str] = dict(SQL)
