"""The dealt queries: each applies its operator to its whole table, with production
parameters, and returns the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm import (
    conversation_repair,
    cover_tree,
    dac,
    hilbert,
    lexical_search,
    mixing,
    nbsvm,
    packing,
    quality_rules,
    secrets,
    substrings,
    warc,
    weighted_minhash,
)
from clickflow.llm.oracles import oracle_sql  # noqa: F401
from clickflow.llm.shared import shared_folder


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _tokenizer(name: str) -> str:
    # Imported where it is used: without the vocabulary files the other queries still work.
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(_read(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_read(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(_read(spark, sf_dir, "documents"))


def op5_dac(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "dac")
    dac.write_segments(_read(spark, sf_dir, "documents"), path, _tokenizer("word_bpe_49k.json"))
    return dac.read_documents(spark, path)


def op6_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard_rows(_read(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "cell",
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _tokenizer("byte_bpe_50k.json")
    return packing.pack(_read(spark, sf_dir, "documents"), path)


def op8_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_minhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op9_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(_read(spark, sf_dir, "embeddings"))


def op10_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = nbsvm.train(docs, labels.where(fold != 2).select("doc_id", "quality"))
    return nbsvm.score(docs, model).select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _read(spark, sf_dir, "conversations")
    return conversation_repair.repair_report(conversations, conversation_repair.damage(conversations))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    warc.write_archives(_read(spark, sf_dir, "pages"), folder)
    found = warc.read_archives(spark, folder, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substrings": op1_substrings,
        "op2_mixing": op2_mixing,
        "op3_quality_rules": op3_quality_rules,
        "op4_secrets": op4_secrets,
        "op5_dac": op5_dac,
        "op6_hilbert": op6_hilbert,
        "op7_packing": op7_packing,
        "op8_weighted_minhash": op8_weighted_minhash,
        "op9_cover_tree": op9_cover_tree,
        "op10_nbsvm": op10_nbsvm,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_warc": op12_warc,
        "op13_lexical_search": op13_lexical_search,
    }
