"""The operators with production parameters over the given tables: one query each."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, chat, codes, decontaminate, langid, likelihood, merkle, neardup, packing, phrases, pii, secrets, tokenfiles
from tidemark.llm.base import table
from tidemark.session import new_folder


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    named = langid.identify(documents, langid.train(documents))
    return named.select(
        "doc_id", (F.coalesce(langid.fold(), F.lit(-1)) == 0).alias("held_out"), F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"), F.col("language.accepted").alias("accepted"),
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    _, placed = packing.pack(table(spark, sf_dir, "documents"), tokenizer, "word", end_id=1)
    return placed


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table names no preferences: of conversations 2k and 2k + 1, the first is taken as chosen."""
    turns = table(spark, sf_dir, "conversations")
    half = F.floor(F.col("conv_id") / 2).cast("long")
    pairs = turns.where("conv_id is not null").select(half.alias("pair_id"), (2 * half).alias("chosen"), (2 * half + 1).alias("rejected"))
    return chat.preference_turns(turns, pairs.distinct())


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = phrases.without_recurring(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (F.size("items") > 0).alias("contaminated"), F.size("items").cast("long").alias("n_items"),
        F.col("items.item_id").alias("items"), F.coalesce(F.array_max("items.overlap"), F.lit(0.0)).alias("overlap"),
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    files = tokenfiles.write_token_files(
        table(spark, sf_dir, "documents"), new_folder(spark, "tokens"), tokenizer, "byte", end_id=0, vocabulary=50_257
    )
    return tokenfiles.read_token_files(files)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", pii.spans("text").alias("found"))
    of = lambda *kinds: F.filter("found", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.BASE]
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", *counts, F.sha2(line(of(*pii.BASE)), 256).alias("base_sha256"), line(F.col("found")).alias("spans"),
                        F.col("found.score").alias("scores"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.documents_manifest(table(spark, sf_dir, "documents"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string")) % 7
    return likelihood.likelihoods(table(spark, sf_dir, "documents"), fold == 2)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_best_fit_packing, op3_secret_scan, op4_chat_formatting, op5_substring_dedup, op6_minhash_near_dedup, op7_benchmark_decontamination, op8_token_files, op9_pii, op10_nearest_neighbours,
    op11_merkle_manifest, op12_lm_scoring, op13_vector_codes,
)}
SQL = {"op4_chat_formatting": chat.SQL, "op11_merkle_manifest": merkle.SQL, "op13_vector_codes": codes.SQL}
