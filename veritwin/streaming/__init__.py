"""Incremental runs with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import trim_ws


#: Folders that arrivals are spread over by pair, so that a batch reads back few of them.
BUCKETS = 256


def stream_pairs(
    spark: SparkSession, source: str, schema: T.StructType, job: Callable[[DataFrame], DataFrame], output: str, checkpoint: str,
    files_per_batch: int = 100,
) -> StreamingQuery:
    """Run ``job`` on pairs as they become complete, and again when more of them arrives.

    ``source`` holds Parquet files of rows (pair_id, side, …) in any order; ``job`` returns rows with pair_id. Arrivals
    are kept below ``output``. A batch runs ``job`` on all that has arrived of each pair it touches, once both
    sides are there, so the files per batch set the pace and not the result. :func:`latest_results` reads the last result
    of each pair. The checkpoint remembers which files are done; a batch that runs twice overwrites itself.
    """
    arrived = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def run(batch: DataFrame, batch_id: int) -> None:
        bucket = F.pmod(F.xxhash64("pair_id"), F.lit(BUCKETS)).cast("int")
        batch.withColumn("_bucket", bucket).write.mode("overwrite").partitionBy("_bucket").parquet(f"{output}/arrivals/_batch={batch_id}")
        kept = batch.sparkSession.read.schema(f"{_ddl(schema)}, _batch long, _bucket int").parquet(f"{output}/arrivals").where(F.col("_batch") <= batch_id)
        touched = kept.where(F.col("_batch") == batch_id).select("_bucket", "pair_id").distinct()
        folders = [r["_bucket"] for r in touched.select("_bucket").distinct().collect()]
        rows = kept.where(F.col("_bucket").isin(folders)).join(touched, ["_bucket", "pair_id"], "left_semi").drop("_batch", "_bucket")
        whole = rows.groupBy("pair_id").agg(F.count_distinct("side").alias("sides")).where("sides = 2")
        job(rows.join(whole, "pair_id", "left_semi")).write.mode("overwrite").parquet(f"{output}/results/_batch={batch_id}")

    return (
        arrived.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_results(spark: SparkSession, output: str) -> DataFrame:
    """The rows of the last batch that compared each pair."""
    results = spark.read.parquet(f"{output}/results")
    last = results.groupBy("pair_id").agg(F.max("_batch").alias("_batch"))
    return results.join(last, ["pair_id", "_batch"], "left_semi").drop("_batch")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def stream_cells_vs_baseline(
    spark: SparkSession, source: str, schema: T.StructType, baseline: DataFrame, output: str, checkpoint: str, files_per_batch: int = 100
) -> StreamingQuery:
    """Compare arriving property cells with the S baseline; counts per (udp, status).

    Arriving rows (owner, udp, value); baseline (owner_key, udp, value), one row
    per cell. The counts are the state; its size is the number of properties.
    """
    arrived = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    known = baseline.select("owner_key", "udp", F.col("value").alias("s_value"), F.lit(True).alias("_known"))
    joined = arrived.withColumn("owner_key", F.lower(trim_ws("owner"))).join(known, ["owner_key", "udp"], "left")
    status = (
        F.when(F.col("_known").isNull(), "EXTRA").when(trim_ws("s_value") == "", "BLANK")
        .when(F.col("s_value") == F.col("value"), "PASS").otherwise("MISMATCH"))
    counts = joined.groupBy("udp", status.alias("status")).agg(F.count("*").alias("cells"))

    def publish(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(output)

    return (
        counts.writeStream.outputMode("complete").foreachBatch(publish).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())
