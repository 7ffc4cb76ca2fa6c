"""Registered queries of the ``llm`` operators: opN_<name> over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficwatch.llm import (
    chat_repair,
    fill_middle,
    hilbert_negatives,
    lang_crf,
    line_windows,
    minhash_join,
    norm_topk,
    oracle,
    packing,
    phrase_index,
    quality_gam,
    url_automaton,
    warc_bundles,
    wavelet_store,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair(table(spark, sf_dir, "conversations"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_index.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key", "n_near_items")


def op4_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_bundles.read_archives(warc_bundles.write_archives(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op6_norm_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_windows.remove_repeated_windows(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op8_url_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_automaton.judge(table(spark, sf_dir, "pages"))


def op9_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet_store.read_tokens(wavelet_store.write_tokens(table(spark, sf_dir, "documents")))


def op10_lang_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lang_crf.label_documents(docs, lang_crf.train(docs))


def op11_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_gam.features(table(spark, sf_dir, "documents"))
    return quality_gam.score(rows, quality_gam.train(rows, table(spark, sf_dir, "labels")))


def op12_hilbert_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hilbert_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    again = fill_middle.restored(F.col("form"), F.col("output"))
    digests = [F.sha2(c.cast("binary"), 256).alias(name) for c, name in ((F.col("output"), "output_sha256"), (again, "restored_sha256"))]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_chat_repair,
        op2_packing,
        op3_phrase_index,
        op4_warc_bundles,
        op5_minhash_join,
        op6_norm_topk,
        op7_line_windows,
        op8_url_automaton,
        op9_wavelet_tokens,
        op10_lang_crf,
        op11_quality_gam,
        op12_hilbert_negatives,
        op13_fill_middle,
    )
    return {f.__name__: f for f in found}


def oracles() -> dict[str, str]:
    return oracle.registry()
