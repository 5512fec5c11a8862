"""Registered queries of the training-data operators: thin digests of their outputs."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerlens.llm import (chat_format, decontaminate, jaccard_join, language_id, license_scan, line_dedup, packing,
                            pii, quality_llr, ranked_search, secret_scan, turn_repair, url_filters)
from sellerlens.llm.common import map_arrow, table
from sellerlens.llm.oracles import ORACLES  # noqa: F401 - part of this module's interface

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _spans_text(spans) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_pii(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return out.select("doc_id", *counts, F.sha2(_spans_text("base"), 256).alias("base_sha256"),
                      _spans_text("spans").alias("spans"),
                      (F.size("spans") - F.size("base")).cast("long").alias("n_found"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                      F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), F.round("score", 6).alias("score"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.measure(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated",
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.cut_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("deleted", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    kept = F.when(F.col("text") == "", F.lit(0)).otherwise(F.size(F.split("text", "\n")))
    return out.select(
        "doc_id", removed.alias("n_deleted_lines"), kept.cast("long").alias("n_kept_lines"),
        F.array_join(F.transform("deleted", lambda x: F.concat_ws(":", x["s"], x["e"])), ",").alias("deleted_runs"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.coalesce(part != 2, F.lit(False)).alias("train"))
    return language_id.identify(docs).select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, keep_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filters.filter_urls(table(spark, sf_dir, "pages"), url_filters.rule_table(spark))
    return out.select("page_id", "host", "path", "rule", "verdict", "decided_by")


def _chat_digest(batches):
    """Everything is read back from the formatted string and its loss spans."""
    for b in batches:
        rows = []
        for conv, text, rewrites, spans in zip(*(b.column(i).to_pylist() for i in range(4))):
            turns = chat_format.parse(text)
            said = "".join(f"{role}\n{t}\n" for role, t in turns)
            loss = "".join(chat_format.unescape(text[x["s"]:x["e"]]) for x in spans if x["loss"])
            digest = [hashlib.sha256(t.encode()).hexdigest() for t in (said, loss)]
            rows.append((conv, len(turns), digest[0], len(loss), digest[1], len(text), rewrites))
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites_history"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 7, types)], names=names)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    return map_arrow(
        chat_format.format_chats(chats.unionByName(extra)), _chat_digest,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "rewrites_history boolean")


def op10_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality_llr.quality_rules(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "llr")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def damaged(chats: DataFrame) -> DataFrame:
    """The rows after damage by crc32('conv_id:turn') % 20; a dropped row only names its conversation."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))  # noqa: E731 - nulls are one space
    rows = chats.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"),
                        F.pmod(F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")), F.lit(20)).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") != 0).alias("present"),
                       F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = turn_repair.repair(damaged(table(spark, sf_dir, "conversations")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                      F.sha2(said, 256).alias("repaired_sha256"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in secret_scan.KINDS]
    return out.select("doc_id", *counts, F.sha2(_spans_text("base"), 256).alias("base_sha256"),
                      _spans_text("spans").alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_learned"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_license_scan": op3_license_scan,
    "op4_decontaminate": op4_decontaminate,
    "op5_line_dedup": op5_line_dedup,
    "op6_language_id": op6_language_id,
    "op7_packing": op7_packing,
    "op8_url_filters": op8_url_filters,
    "op9_chat_format": op9_chat_format,
    "op10_quality_llr": op10_quality_llr,
    "op11_ranked_search": op11_ranked_search,
    "op12_turn_repair": op12_turn_repair,
    "op13_secret_scan": op13_secret_scan,
}
