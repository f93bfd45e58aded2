"""The registered queries of the numbered operators; each derives its digest columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm import bpe, huffman, langid
from pairloom.llm.audit import audit
from pairloom.llm.chat import format_chats
from pairloom.llm.checks import audit_sql, codes_sql, licenses_sql
from pairloom.llm.decontaminate import benchmark_hits
from pairloom.llm.extract import extract
from pairloom.llm.laesa import compress
from pairloom.llm.licenses import PERCENT, SLACK, TEMPLATES, license_report
from pairloom.llm.minhash import near_duplicates
from pairloom.llm.quantise import near_vectors
from pairloom.llm.stages import read
from pairloom.llm.substring import remove_repeats
from pairloom.llm.toxicity import THRESHOLD, held_out, toxicity
from pairloom.session import fresh_path

Plan = Callable[[SparkSession, str], DataFrame]


def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read(spark, folder, "documents"))


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = benchmark_hits(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    covered = F.aggregate(F.zip_with("begins", "ends", lambda b, e: (e - b).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x)
    named = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(named, 256).alias("items_sha256"),
        (covered > 0).alias("contaminated"),
    )


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(read(spark, folder, "documents"), path), path)
    return coded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_substring(spark: SparkSession, folder: str) -> DataFrame:
    done = remove_repeats(read(spark, folder, "documents"))
    return done.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    learned = read(spark, folder, "labels").where(~held_out("doc_id"))
    scored = toxicity(read(spark, folder, "documents"), learned)
    return scored.select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def op6_langid(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    training = documents.where(~held_out("doc_id")).select("text", "lang")
    found = langid.identify(documents, training, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), F.col("lang").alias("lang_pred"), "score")


def op5_extract(spark: SparkSession, folder: str) -> DataFrame:
    found = extract(read(spark, folder, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op10_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "token-ids")
    huffman.write_ids(read(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    done = huffman.documents_of(spark, path)
    return done.select(F.col("id").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), F.col("crc32").alias("ids_crc32"))


def op9_embedding(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(read(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


def op7_chat(spark: SparkSession, folder: str) -> DataFrame:
    lines = format_chats(read(spark, folder, "conversations"))
    return lines.select(F.col("conv").alias("conv_id"), "turn", "kind", "after", F.col("level").cast("bigint").alias("level"), "valid", F.sha2("line", 256).alias("line_sha256"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    done = compress(read(spark, folder, "embeddings"))
    return done.rows.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(done.digest()).alias("codebooks_sha256"))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op13_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_report(read(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Plan] = {
    "op1_minhash": op1_minhash,
    "op2_decontaminate": op2_decontaminate,
    "op3_bpe": op3_bpe,
    "op4_toxicity": op4_toxicity,
    "op5_extract": op5_extract,
    "op6_langid": op6_langid,
    "op7_chat": op7_chat,
    "op8_substring": op8_substring,
    "op9_embedding": op9_embedding,
    "op10_token_ids": op10_token_ids,
    "op11_vector_codes": op11_vector_codes,
    "op12_filter_audit": op12_filter_audit,
    "op13_licenses": op13_licenses,
}
# The tables hold no tool calls: every row is a plain message. Linking is tested on fixtures.
_CHAT = """
select conv_id, turn, 'message' as kind, turn as after, 0::bigint as level, true as valid,
  sha256('{"content":' || to_json(coalesce(text, '')) || ',"role":' || to_json(coalesce(role, '')) || '}') as line_sha256
from conversations
"""

CHECKS: dict[str, str] = {
    "op7_chat": _CHAT,
    "op11_vector_codes": codes_sql(),
    "op12_filter_audit": audit_sql(),
    "op13_licenses": licenses_sql(TEMPLATES, SLACK, PERCENT),
}
