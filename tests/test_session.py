"""What a written relation leaves behind."""

import time
from pathlib import Path

from pyspark.sql import functions as F

from veritwin.session import FREE_SHUFFLES, cut, stored


def shuffles(spark) -> set[str]:
    """Names of the shuffle files that lie in the local folders now."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.name for d in manager.localDirs() for f in Path(d.getPath()).rglob("shuffle_*.data")}


def test_written_relations_are_compressed_and_leave_no_shuffle(spark):
    rows = spark.range(200_000).select((F.col("id") % 50_000).alias("k"), F.concat(F.lit("the same long text of a finding " * 8), F.col("id") % 7).alias("text"))
    before, setting = shuffles(spark), spark.conf.get(FREE_SHUFFLES)
    for write in (cut, lambda df: stored(df, "x")):
        found = write(rows.repartition(4, "k").groupBy("k").agg(F.max("text").alias("text")))
        assert found.count() == 50_000 and found.columns == ["k", "text"]
        assert sum(Path(f.removeprefix("file:")).stat().st_size for f in found.inputFiles()) < 2_000_000
        left = time.time() + 30
        while len(shuffles(spark) - before) > 4 and time.time() < left:  # freed in the background; the count's own may stay
            time.sleep(0.5)
        assert spark.conf.get(FREE_SHUFFLES) == setting
    made = {n for n in shuffles(spark) - before}
    assert len({n.split("_")[1] for n in made}) <= 2, made  # those of the two counts


def test_a_failed_write_restores_the_setting(spark):
    setting = spark.conf.get(FREE_SHUFFLES)
    try:
        cut(spark.range(1).select(F.raise_error(F.lit("no")).cast("string").alias("x")))
    except Exception:
        pass
    else:
        raise AssertionError
    assert spark.conf.get(FREE_SHUFFLES) == setting
