"""The dealt operators as named queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickledger.llm import langid
from clickledger.llm.alignment import align
from clickledger.llm.ann import nearest_neighbours
from clickledger.llm.bpe import encode
from clickledger.llm.common import fold, table
from clickledger.llm.importance import resample
from clickledger.llm.licences import known_licences, scan
from clickledger.llm.neardup import near_duplicates
from clickledger.llm.ngram_join import ngram_join
from clickledger.llm.packing import pack
from clickledger.llm.quality import score, size_class, train
from clickledger.llm.rules import apply_rules
from clickledger.llm.sharding import shard_documents
from clickledger.llm.warc import archive_and_read, page_of

Query = Callable[[SparkSession, str], DataFrame]


def op1_factorisation_machine(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").filter(fold("doc_id", 5) != 0)
    metadata = [size_class("n_chars")]
    model = train(docs, labels.select("doc_id", F.col("quality").alias("target")), metadata)
    return score(docs, model, metadata).select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096
    )
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op3_zstandard_archives(spark: SparkSession, folder: str) -> DataFrame:
    read = archive_and_read(table(spark, folder, "pages"))
    fault = F.raise_error(F.concat_ws(" ", "path", "number", "error"))
    return read.select(
        F.when(F.col("error").isNotNull(), fault.cast("long")).otherwise(page_of("record_id")).alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("long"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha2("payload", 256), "digest").alias("payload_digest"),
        "record_type",
        page_of("refers_to").alias("refers_to"),
    )


def op4_conditional_random_field(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.train(docs.filter(fold("doc_id", 3) != 1))
    return langid.identify(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op5_canonical_digests(spark: SparkSession, folder: str, known: DataFrame | None = None) -> DataFrame:
    """``known(license_id, text)``: other known texts than those of the library."""
    return scan(table(spark, folder, "documents"), known_licences(spark) if known is None else known)


def op6_label_propagation(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents"), 16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_distinct_word_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, folder, "documents")
    return encode(docs, ranks, public_tokenizers.PATTERN, round_trip=True).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_rule_cascade(spark: SparkSession, folder: str) -> DataFrame:
    return apply_rules(table(spark, folder, "documents")).drop("rejected_by")


def op9_one_bit_codes(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_neighbours(table(spark, folder, "embeddings"), every=100, k=10)


def op10_superminhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), width=4, percent=80)


def op11_galloping_alignment(spark: SparkSession, folder: str) -> DataFrame:
    byte_level, pieces = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align(table(spark, folder, "documents"), byte_level, pieces)


def op12_segment_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs, target = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return resample(docs, target, width=1, buckets=10_000, percent=10, least_words=20, seed=2024)


def op13_prefix_tree_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join(table(spark, folder, "documents"), width=4, percent=85)


QUERIES: dict[str, Query] = {
    "op1_factorisation_machine": op1_factorisation_machine,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_zstandard_archives": op3_zstandard_archives,
    "op4_conditional_random_field": op4_conditional_random_field,
    "op5_canonical_digests": op5_canonical_digests,
    "op6_label_propagation": op6_label_propagation,
    "op7_distinct_word_bpe": op7_distinct_word_bpe,
    "op8_rule_cascade": op8_rule_cascade,
    "op9_one_bit_codes": op9_one_bit_codes,
    "op10_superminhash": op10_superminhash,
    "op11_galloping_alignment": op11_galloping_alignment,
    "op12_segment_resampling": op12_segment_resampling,
    "op13_prefix_tree_join": op13_prefix_tree_join,
}
