"""Corpus pipeline over ``documents``: STAGES in order, each written and reread as the next one's input.

Every stage works on all documents that its predecessor kept. All but the last
return the columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerlens.llm import decontaminate, jaccard_join, line_dedup, packing, quality_llr
from sellerlens.llm.common import drop_listed, materialise, packed, table, unpacked

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; labels only mark the trusted target."""
    out = quality_llr.quality_rules(packed(docs), table(spark, sf_dir, "labels"))
    return unpacked(out.where("kept"), docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; a text of which no word is left goes."""
    out = line_dedup.cut_lines(docs)
    left = (F.size("deleted") == 0) | F.col("text").rlike(line_dedup.WORD)
    return line_dedup.remaining(out.where(left), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id."""
    found = jaccard_join.components(docs)
    return drop_listed(docs, "doc_id", found.where("component_id <> doc_id").select("doc_id").distinct())


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated texts without their benchmark spans, or gone where these cover most of the text."""
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, TOKENIZER, keep_ids=False).drop("ids")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("jaccard_join", near_duplicates),
    ("decontaminate", benchmark),
    ("packing", pack),
]

# Byte-pair ids and the order in which windows fill have no SQL form: the tests run
# each stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
