"""A corpus pipeline of five stages, each an operator of ``telemill.llm`` on what the stage before it kept.

Rows pass with all their columns; a stage that changes a text also renews ``n_chars``. Null and empty
texts leave at the first stage. The last stage gives per document its ids and decoded text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.llm import decontaminate, line_dedup, ngram_join, piece_codec, quality
from telemill.llm.common import free_name, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules, without their failing lines."""
    return quality.clean_documents(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of three lines that an earlier one holds; emptied documents go."""
    removed = free_name(docs, "removed")
    out = line_dedup.dedup_lines(docs, count=removed).filter((F.col(removed) == 0) | (F.translate("text", " \t\n\x0b\x0c\r", "") != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates.

    Only what goes is joined; rows with a null id are not compared and stay, and of rows that repeat
    an id with the same n-grams one stays. Each text of an id with several is judged by itself.
    """
    mark = free_name(docs, "print")
    known = docs.filter("doc_id IS NOT NULL").withColumn(mark, ngram_join.text_print(F.col("text")))
    found = written(ngram_join.joined(known).select("doc_id", "print", "same", "class_id"), "near-rows")
    sets = found.groupBy("doc_id", "same").agg(F.min("print").alias("least"), F.max("print").alias("most")).filter("least <> most")
    again = found.join(sets, ["doc_id", "same"]).filter("print <> least")
    gone = found.filter("doc_id <> class_id").unionByName(again.select(found.columns))
    gone = gone.select("doc_id", F.col("print").alias(mark)).distinct()
    kept = known.join(gone, ["doc_id", mark], "left_anti").dropDuplicates(["doc_id", mark])
    return kept.select(docs.columns).unionByName(docs.filter("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, be it with a few edits."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of each document."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = piece_codec.encode_texts(texts, public_tokenizers.path("piece_bpe_32k.model"))
    ids = piece_codec.ids_of("ids")
    return out.select("doc_id", F.size(ids).cast("bigint").alias("n_tokens"), ids.alias("ids"), "decoded")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", encoding),
]

#: MinHash, edit distance and piece merges have no SQL form; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
