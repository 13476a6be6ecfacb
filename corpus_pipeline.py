"""The corpus pipeline: five stages of the training-data operators over ``documents``.

Each stage takes what its predecessor kept, as a table in the cluster's shared
folder, so a lost executor costs at most the stage at hand.  All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webstats.llm.bpe_codec import bpe_encode
from webstats.llm.common import stored, table
from webstats.llm.hd_langid import UNKNOWN, fit_profiles, held_out, predict_language
from webstats.llm.markov_secrets import fit_models, redact, scan_secrets
from webstats.llm.queries import vocabulary_path
from webstats.llm.signature_tree_join import link_classes
from webstats.llm.template_decontamination import drop_contaminated

#: letters from which on a cosine below the second number resembles no learned language. Of 400 random strings
#: over a-z at each of six lengths, with and without blanks, none of 60 or more letters passed (largest 0.13, with 4,000
#: characters 0.18); the least of 400 held-out documents was 0.25. Shorter texts overlap with noise, so some noise stays.
LEAST_SCORES = [(0, 0.02), (20, 0.1), (60, 0.15), (2_000, 0.2)]


def resembles(score: Column, text: Column) -> Column:
    """The cosine is above what random letters of the text's length reach."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    least = F.lit(LEAST_SCORES[0][1])
    for n, bound in LEAST_SCORES[1:]:
        least = F.when(letters >= n, F.lit(bound)).otherwise(least)
    return (score >= LEAST_SCORES[-1][1]) | (score >= least)      # letters are only counted where the score is low


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that resemble a learned language; texts without letters and letter noise (of 60 or more letters) go."""
    profiles = fit_profiles(docs.where(~held_out()))
    kept = predict_language(docs, profiles).where((F.col("lang_pred") != UNKNOWN) & resembles(F.col("score"), F.col("text")))
    return kept.select(*docs.columns)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked documents: the one with the smallest id.

    Different texts under one id all stay if one of them does, equal ones once. Rows without an id are in no class:
    each of their texts stays once.
    """
    classes = link_classes(docs).where(F.col("component_id") == F.col("doc_id")).select("doc_id").distinct()
    kept = docs.join(classes, "doc_id", "left_semi").select(*docs.columns)
    # only ids that repeat have texts to compare: all others pass without a sort of texts
    many = stored(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "pipeline-repeated")
    if many.where("doc_id IS NOT NULL").limit(1).count():
        again = kept.join(many, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
        kept = kept.join(many, "doc_id", "left_anti").unionByName(again)
    nameless = docs.where(F.col("doc_id").isNull())
    return kept.unionByName(nameless.dropDuplicates(["text"])) if nameless.limit(1).count() else kept


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give away no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` follows the text."""
    found = scan_secrets(docs, fit_models(docs)).withColumn("clean", redact(F.col("text"), F.col("found")))
    changed = F.size("found") > 0
    return found.withColumn("n_chars", F.when(changed, F.length("clean")).otherwise(F.col("n_chars")).cast("long")).withColumn(
        "text", F.col("clean")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents with their token ids."""
    return bpe_encode(docs, vocabulary_path())


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", one_of_each_class),
    ("decontamination", decontaminate),
    ("secret_scan", redact_secrets),
    ("bpe_encoding", encode),
]

#: the BPE stage and the language models can't be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
