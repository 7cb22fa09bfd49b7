"""A corpus from raw documents to piece ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; each result is written as Parquet
and read again. The first four return the columns of their input, whatever these are; the last one returns the
encoded documents. Rows are carried whole through the operators, so repeated and null ids lose nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritwin.llm import decontaminate, language, neardup, pieces, pii
from veritwin.llm.common import remainder, shared_table

#: No language needs a share of a text's words: texts in several languages stay. The plain version in the tests reads it.
LEAST_SHARE = 0.0


def whole_rows(docs: DataFrame) -> DataFrame:
    """row (all columns as one struct) and text."""
    return docs.select(F.struct("*").alias("row"), F.col("text"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of any language or several; only texts without a letter go. Labels are only learned from.

    Without a labelled text to learn from no language is known and no document stays.
    """
    model = language.learn(docs.where(remainder("doc_id", 4) != 2))
    found = language.identify(whole_rows(docs), model, "row", "text")
    return found.where(F.col("lang_pred") != language.UNKNOWN).select("doc_id.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id, and of rows that share it the least row.

    Rows without doc_id link with nothing and stay.
    """
    removed = neardup.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(removed, "doc_id", "left_anti")
    one = named.groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return one.unionByName(docs.where("doc_id is null"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(whole_rows(docs), benchmark, "row", "text")
    return found.where("not contaminated").select("doc_id.*")


def masked(text: Column, spans: Column) -> Column:
    """``text`` with the name of its kind in the place of each span; overlapping spans are one, named by the first."""
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<from:int,start:int,end:int,kind:string>>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        return F.when(
            s["start"] >= acc["end"],
            F.struct(s["end"].alias("end"), F.concat(acc["out"], F.array(F.struct(
                acc["end"].alias("from"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))).alias("out")),
        ).otherwise(F.struct(F.greatest(acc["end"], s["end"]).alias("end"), acc["out"].alias("out")))

    def line(acc: Column) -> Column:
        parts = F.transform(acc["out"], lambda s: F.concat(F.substring(text, s["from"] + 1, s["start"] - s["from"]), F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.concat(F.array_join(parts, ""), F.substring(text, acc["end"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, line)).otherwise(text)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; each span of personal data is replaced by the name of its kind. n_chars follows the text."""
    found = pii.find_pii(whole_rows(docs), "row", "text").select("doc_id.*", F.col("spans").alias("spans of personal data"))
    changed = found.withColumn("text", masked(F.col("text"), F.col("`spans of personal data`"))).select(*[F.col(f"`{c}`") for c in docs.columns])
    if "n_chars" not in docs.columns:
        return changed
    return changed.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_pieces, ids, round_trip."""
    return pieces.encode(docs, pieces.load())


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("SentencePiece encoding", piece_ids),
]

#: Automata, a random field and piece lattices are not SQL; tests/llm/test_pipeline.py has the plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = shared_table(docs, f"stage-{n}")
    return docs
