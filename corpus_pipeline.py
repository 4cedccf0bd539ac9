"""From raw documents to a training corpus: the stages in order, each a function of (spark, docs, sf_dir)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.llm import bpe, jaccard, langid, linededup, winnow
from fieldbook.session import stage

#: language scores below this are no answer
MIN_LANGUAGE_SCORE = 0.3
VOCABULARY = "byte_bpe_50k.tiktoken"


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; those without a letter or a language that stands out go."""
    tagged = langid.tag(docs, langid.learn(docs))
    return tagged.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a later document keeps."""
    kept = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs)).drop("text").withColumnRenamed("kept_text", "text")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five words, similarity 0.8)."""
    found = jaccard.jaccard_components(docs, k=5, percent=80)
    gone = found.where("not (component_id <=> doc_id)").select("doc_id").distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty is from benchmark windows."""
    found = winnow.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = found.where("contaminated").select("doc_id").distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the digest of what they decode to."""
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", keep_languages),
    ("line_dedup", drop_repeated_lines),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", tokenize),
]

#: language ID and tokens are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
