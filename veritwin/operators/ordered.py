"""Numbering and carrying values forward inside groups of any size.

A window over a group sends the whole group to one task, which is wrong for a group that holds a third of
the data. So groups of more rows than a block are cut into range blocks by order, each block gets a plain window, and the
summaries of the blocks (one row per group and block) are carried over. The number of blocks follows the number of
rows, so a block keeps its size as the data grows. Groups that fit a block get a plain window; their numbers are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut, stored

#: Rows of a block, about; the range bounds are sampled.
BLOCK_ROWS = 1_000_000


def _same(cols: list[str], a: str, b: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return cond


def _split(df: DataFrame, group: list[str], written: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Rows of groups that fit a block, and rows of the others if there are any. The input is evaluated once."""
    kept = df if written else stored(df, "rows")
    if kept.count() <= BLOCK_ROWS:
        return kept, None
    # At most one group per BLOCK_ROWS rows.
    large = cut(kept.groupBy(*group).count().where(F.col("count") > BLOCK_ROWS).select(*group))
    if large.isEmpty():
        return kept, None
    rows, keys = kept.alias("k"), large.alias("l")
    # So few groups travel to the rows, not the rows to their group.
    keys, same = F.broadcast(keys), _same(group, "k", "l")
    return rows.join(keys, same, "left_anti"), rows.join(keys, same, "left_semi")


def _blocks(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Rows with a block number that grows with the order inside each group.

    The range bounds come from a sample, so the result is written once and read
    by both consumers; a second run could cut elsewhere.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(max(least, -(-df.count() // BLOCK_ROWS)), *group, *order)
    return stored(ranged.withColumn("_block", F.spark_partition_id()), "blocks")


def number_within(df: DataFrame, group: list[str], order: list[str], out: str = "rn", written: bool = False) -> DataFrame:
    """1, 2, 3 … inside each group. ``order`` must give a total order. ``written``: ``df`` is a table already."""
    small, large = _split(df, group, written)
    numbered = small.withColumn(out, F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    if large is None:
        return numbered
    blocks = _blocks(large, group, order)
    sizes = blocks.groupBy(*group, "_block").count()
    before = W.partitionBy(*group).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        *group, "_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
    )
    inside = F.row_number().over(W.partitionBy(*group, "_block").orderBy(*order))
    joined = (
        blocks.withColumn("_inside", inside).alias("b")
        .join(F.broadcast(starts.alias("s")), _same([*group, "_block"], "b", "s"))
        .select("b.*", "s._start")
    )
    rest = joined.withColumn(out, (F.col("_inside") + F.col("_start")).cast("int")).select(*df.columns, out)
    return numbered.unionByName(rest)


def fill_forward(df: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """The last non-NULL ``value`` at or before each row of its group."""
    small, large = _split(df, group)
    so_far = W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    filled = small.withColumn(out, F.last(value, ignorenulls=True).over(so_far))
    if large is None:
        return filled
    blocks = _blocks(large, group, order)
    last = blocks.where(F.col(value).isNotNull()).groupBy(*group, "_block").agg(
        F.max_by(F.col(value), F.struct(*order)).alias("_last")
    )
    every = blocks.select(*group, "_block").distinct().alias("e")
    tails = every.join(last.alias("l"), _same([*group, "_block"], "e", "l"), "left").select(
        "e.*", "l._last"
    )
    before = W.partitionBy(*group).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carry = tails.select(
        *group, "_block", F.last("_last", ignorenulls=True).over(before).alias("_carry")
    )
    inside = W.partitionBy(*group, "_block").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    joined = (
        blocks.withColumn("_inside", F.last(value, ignorenulls=True).over(inside)).alias("b")
        .join(F.broadcast(carry.alias("c")), _same([*group, "_block"], "b", "c"))
        .select("b.*", "c._carry")
    )
    return filled.unionByName(joined.withColumn(out, F.coalesce("_inside", "_carry")).select(*df.columns, out))


def keep_one(df: DataFrame, group: list[str], order: list[str | Column]) -> DataFrame:
    """First row of each group in ``order``.

    Written as ``row_number() = 1``: the optimizer keeps one row per group and
    task before the shuffle, so a large group never travels.
    """
    rank = F.row_number().over(W.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
