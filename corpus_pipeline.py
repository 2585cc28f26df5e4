"""Corpus pipeline: quality, line rules, near duplicates, mixing, packing; each stage reads the last one's table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listflow.llm import line_rules, mixing, packing, quality, queries, similar
from listflow.llm.frames import packed, unpacked
from listflow.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality trees don't reject; they learn from all but the held-out fold of the labels."""
    forest = quality.fit_quality(docs, queries.table(spark, sf_dir, "labels"))
    scored = quality.score_quality(packed(docs, text=F.col("text")), forest)
    return unpacked(scored.filter("score >= 0.3"), docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line rules, without their failing lines."""
    judged = line_rules.line_first(packed(docs, text=F.col("text"))).filter("kept")
    return unpacked(judged, docs.columns, text=F.col("cleaned"), n_chars=F.length("cleaned").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return similar.one_of_each(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the weighted mix takes them."""
    return mixing.apply_mix(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in packed sequences."""
    pieces = packing.token_pieces(docs, queries.vocabulary())
    return packing.pack(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixing_sources),
    ("packing", packed_sequences),
]

#: Trained trees, tokenizer ids and hash bands have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; every stage's table is written to the shared folder and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
