"""Pairs of files: finding them, resuming, keeping bad ones apart; result sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import text
from ..operators.ordered import keep_one


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, modified, bytes) of the files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def base_name(path: str | Column) -> Column:
    """Upper-case file name without folder and extension."""
    name = F.element_at(F.split(text(path), r"[/\\]"), -1)
    return F.upper(F.regexp_replace(name, r"\.[^.]*$", ""))


def discover_pairs(s_files: DataFrame, t_files: DataFrame, strategy: str = "filename", mapping: DataFrame | None = None) -> DataFrame:
    """One row per pair key: both paths, MATCHED, MISSING or EXTRA, and how many files claim it.

    ``filename`` pairs by base name, ``csv`` by a mapping (s_file, t_file). The first path of a
    key counts; :func:`duplicate_files` lists the others.
    """
    s, t = (
        d.groupBy("pair_key").agg(F.min("path").alias(f"{p}_path"), F.count("*").alias(f"{p}_files"))
        for d, p in zip(_keyed(s_files, t_files, strategy, mapping), ("s", "t"))
    )
    both = s.join(t, "pair_key", "full").fillna(0, subset=["s_files", "t_files"])
    status = F.when(F.col("s_files") == 0, "EXTRA").when(F.col("t_files") == 0, "MISSING").otherwise("MATCHED")
    return both.withColumn("status", status)


def duplicate_files(s_files: DataFrame, t_files: DataFrame, strategy: str = "filename", mapping: DataFrame | None = None) -> DataFrame:
    """pair_key, side, path, DUPLICATE: every file of a key beyond the first path."""
    rows = []
    for files, side in zip(_keyed(s_files, t_files, strategy, mapping), ("S", "T")):
        first = files.groupBy("pair_key").agg(F.min("path").alias("first"))
        rows.append(files.join(first, "pair_key").where("path > first").select(
            "pair_key", F.lit(side).alias("side"), "path", F.lit("DUPLICATE").alias("status")))
    return rows[0].unionByName(rows[1])


def _keyed(s_files: DataFrame, t_files: DataFrame, strategy: str, mapping: DataFrame | None) -> list[DataFrame]:
    """(pair_key, path) of both sides."""
    if strategy == "filename":
        return [f.select(base_name("path").alias("pair_key"), "path") for f in (s_files, t_files)]
    if strategy != "csv":
        raise ValueError(f"unknown pairing strategy {strategy!r}")
    if mapping is None:
        raise ValueError("strategy csv needs a mapping")
    s_key = mapping.select(base_name("s_file").alias("_name"), base_name("s_file").alias("pair_key"))
    t_key = mapping.select(base_name("t_file").alias("_name"), base_name("s_file").alias("pair_key"))
    return [
        f.withColumn("_name", base_name("path")).join(k.distinct(), "_name").select("pair_key", "path")
        for f, k in ((s_files, s_key), (t_files, t_key))
    ]


def pending_pairs(pairs: DataFrame, completed: DataFrame, key: str = "pair_key") -> DataFrame:
    """Pairs that no earlier run has finished."""
    return pairs.join(completed.select(key).distinct(), key, "left_anti")


def quarantine_parse_errors(df: DataFrame, column: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows with ``parsed``, bad rows with the raw text). A bad record never stops a batch."""
    target = T._parse_datatype_string(schema).add("_corrupt", "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = df.withColumn("parsed", F.from_json(F.col(column), target, options))
    bad = F.col("parsed").isNull() | F.col("parsed._corrupt").isNotNull()
    good = parsed.where(~bad).withColumn("parsed", F.col("parsed").dropFields("_corrupt"))
    return good, parsed.where(bad).select(*df.columns)


# --- sinks ----------------------------------------------------------------------------


def write_findings(findings: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ("severity",)) -> None:
    """Findings as a partitioned table, or as a CSV or JSON export for people."""
    writer = findings.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", "true").option("escape", '"').csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        writer.partitionBy(*partition_by).parquet(path)


def append_ledger(rows: DataFrame, path: str) -> None:
    """One JSON object per line; earlier lines stay."""
    rows.write.mode("append").json(path)


def read_ledger(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def latest_by(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest record of each key."""
    return keep_one(df, list(key), [F.desc(c) for c in order])


def element_census(df: DataFrame, id_cols: Sequence[str], column: str, tags: Sequence[str], pointer: str) -> DataFrame:
    """Per row and tag of a markup text: definitions, and elements that only point elsewhere.

    An element with the ``pointer`` attribute refers to an object, it does not define one.
    """
    names = "|".join(tags)
    found = F.regexp_extract_all(F.col(column), F.lit(rf"<((?:{names})(?:\s[^<>]*)?)/?>"), F.lit(1))
    elements = df.select(*id_cols, F.explode(found).alias("_e"))
    tag = F.lower(F.regexp_extract("_e", r"^(\w+)", 1)).alias("tag")
    points = F.col("_e").rlike(rf"\s{pointer}\s*=")
    return elements.groupBy(*id_cols, tag).agg(
        F.count(F.when(~points, True)).alias("definitions"), F.count(F.when(points, True)).alias("pointers"))


