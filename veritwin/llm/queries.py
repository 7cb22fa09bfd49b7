"""The queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, hashing, infill, language, licenses, neardup, orc_ids, pieces, pii, secrets, suffix_tree, table_means, tokens
from .common import digest, remainder, span_list
from .oracles import ORACLES  # noqa: F401  (the entry reads it here)

QUERIES: dict = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spans_of(kind: str):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def span_digests(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    counts = [spans_of(k).alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, digest(span_list("base")).alias("base_sha256"), span_list("spans").alias("spans"))


@register
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(secrets.find_secrets(table(spark, sf_dir, "documents")), ("assign", "access", "hex"))


@register
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(pii.find_pii(table(spark, sf_dir, "documents")), pii.BASE_KINDS)


@register
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


@register
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    found = language.identify(docs, language.learn(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.context_totals(tokens.length_histogram(tokens.encoded_lengths(table(spark, sf_dir, "documents"))))


@register
def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 7) == 2
    counts, tree = suffix_tree.learn(docs.where(~held_out))
    found = suffix_tree.scores(docs, counts, tree)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register
def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing.near_vectors(table(spark, sf_dir, "embeddings"))


@register
def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), pieces.load())


@register
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = infill.restore(infill.transform(table(spark, sf_dir, "documents")))
    return back.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(F.col("restored")).alias("restored_sha256"))


@register
def op12_orc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orc_ids.positions(orc_ids.stored(table(spark, sf_dir, "documents")))


@register
def op13_table_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_means.cluster(table(spark, sf_dir, "embeddings"))
