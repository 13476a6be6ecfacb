"""One registered query per training-data operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webstats.llm.bpe_codec import bpe_decode, bpe_encode
from webstats.llm.common import table
from webstats.llm.hd_langid import fit_profiles, held_out, predict_language
from webstats.llm.license_index import license_vocabulary, scan_licenses, word_idf
from webstats.llm.markov_secrets import fit_models, listing, scan_secrets
from webstats.llm.merkle_manifest import fold_path, merkle_manifest, path_digest
from webstats.llm.minimax_sharding import shard_minimax
from webstats.llm.oracle import ORACLE_SQL  # noqa: F401  (read by __spark_entry__)
from webstats.llm.signature_tree_join import link_classes
from webstats.llm.simhash_pigeonring import simhash_classes
from webstats.llm.spelling_kdtree import spelling_variants
from webstats.llm.stable_projection_ann import nearest
from webstats.llm.superkmer_dedup import dedup_substrings
from webstats.llm.tagpath_extract import extract_main_text
from webstats.llm.template_decontamination import find_contamination


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op3_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    slim = shard_minimax(docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))), 16)
    return slim.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op4_hd_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = fit_profiles(docs.where(~held_out()))
    return predict_language(docs.select("doc_id", "text"), profiles).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe_encode(docs, vocabulary_path()).select("doc_id", "n_tokens", "ids")
    return bpe_decode(ids, vocabulary_path()).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs, fit_models(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(listing(F.col("base")).cast("binary"), 256).alias("base_sha256"), listing(F.col("found")).alias("spans"))


def op7_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_classes(table(spark, sf_dir, "documents"))


def op8_tagpath_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_stable_projection_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = nearest(rows, rows.where(F.col("vec_id") % 20 == 0), "vec_id", "embedding", 20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op10_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_licenses(docs, word_idf(docs, license_vocabulary()))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")     # noqa: E731
    best = F.coalesce(F.array_max("matches.coverage"), F.lit(0.0))
    return found.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").cast("long").alias("first_word"), F.array_max("places.start").cast("long").alias("last_word"),
        joined(F.col("places.label")).alias("base_labels"),
        joined(F.concat("places.label", "matches.label")).alias("labels"), best.alias("score"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    proven = merkle_manifest(table(spark, sf_dir, "documents"))
    folded = proven.withColumn("folded_root", fold_path(F.col("altered"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op13_spelling_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_template_decontamination": op1_template_decontamination,
    "op2_superkmer_dedup": op2_superkmer_dedup,
    "op3_minimax_sharding": op3_minimax_sharding,
    "op4_hd_langid": op4_hd_langid,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_markov_secrets": op6_markov_secrets,
    "op7_signature_tree_join": op7_signature_tree_join,
    "op8_tagpath_extract": op8_tagpath_extract,
    "op9_stable_projection_ann": op9_stable_projection_ann,
    "op10_license_index": op10_license_index,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_simhash_pigeonring": op12_simhash_pigeonring,
    "op13_spelling_kdtree": op13_spelling_kdtree,
}
