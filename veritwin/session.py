"""Session settings, and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "8", app: str = "veritwin") -> SparkSession:
    """A session for tests and benches on one machine; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    It is the folder the cluster names in ``spark.checkpoint.dir``. A folder of
    this machine is made only in local mode, where all tasks see it.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="veritwin-"))
        current = context.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the copy.

    Used where a relation feeds several later steps (the remainder of a matching
    pass, the alias of an entity match): without it every consumer would plan and
    run the whole history again. The copy outlives lost executors; it is Parquet, as
    the rows of a checkpoint are not compressed.
    """
    return stored(df, "cut")


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and go on from it.

    For wide relations that several later steps read a few columns of; unlike a checkpoint, the copy can be pruned.
    The shuffle files of the write go with its end, as nothing reads them again.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES, "false")
    conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        conf.set(FREE_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)
