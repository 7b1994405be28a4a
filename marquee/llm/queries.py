"""Registered queries of the operators, with the digest columns their contracts name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, embeddings, line_dedup, lm, minhash, packing, quality, repair, sharding, spelling, urls, warc
from .common import tokenizer_path
from .oracle import SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(F.col("row.doc_id").alias("doc_id"), *quality.FEATURES, "base_failed", "kept")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(probe).alias("text"))
    back = chat.read_back(chat.format_conversations(turns.unionByName(extra)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                      F.sha2("_text", 256).alias("kept_sha256"))


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf_dir, "documents"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_pages(warc.archive_pages(table(spark, sf_dir, "pages")))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(table(spark, sf_dir, "conversations"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_embeddings, op3_quality, op4_chat, op5_line_dedup, op6_lm, op7_minhash,
                                    op8_urls, op9_sharding, op10_bpe, op11_spelling, op12_warc, op13_repair)}


def oracle() -> dict[str, str]:
    return dict(SQL)
