"""Session construction, checkpoint location and lineage cutting."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tabforge", cpus: str = "*") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TABFORGE_DRIVER_MEMORY", "12g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, taking the cluster's own setting first.

    Only a local master may fall back to a temporary folder: on a cluster every
    executor must see the same path, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="tabforge-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably so later rounds do not replay its plan."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a hand-off table inside the shared checkpoint folder."""
    import uuid

    return f"{ensure_checkpoint_dir(spark)}/tabforge-{name}-{uuid.uuid4().hex}"


def handed_off(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again, for tables whose partitioning means nothing.

    Like ``cut_lineage``, but its columns are packed, where a checkpoint keeps rows as they are in memory.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a training partition of a small table and of a large one, training partitions up to
#: which a table is small, and at most.
TRAINING_ROWS, LARGE_ROWS, SMALL_PARTITIONS, TRAINING_PARTITIONS = 2_000, 50_000, 64, 10_000


def training_partitions(rows: int) -> int:
    """Partitions of a training table, by its number of rows alone.

    An iterative learner starts a task a partition in every step, and each task sends its sums to
    the driver, so partitions of a large table hold more rows.
    """
    small, large = -(-rows // TRAINING_ROWS), -(-rows // LARGE_ROWS)
    return min(max(1, min(small, SMALL_PARTITIONS), large), TRAINING_PARTITIONS)


def training_table(df: DataFrame, row_id: str) -> DataFrame:
    """Materialise ``df`` in partitions that depend on its rows alone.

    Learners that sample rows draw by partition, so a fit follows the partitioning. Here it is
    the hash of the row id, into as many parts as the number of rows gives, each in order of the
    id; cores, files and earlier shuffles change nothing.
    """
    return cut_lineage(df.repartition(training_partitions(df.count()), row_id).sortWithinPartitions(row_id))


#: Partitions of a small table that a learner scans in hundreds of short steps.
STEP_PARTITIONS = 24


def step_partitions(partitions: int) -> int:
    """Partitions for learners of many short steps: a large table, whose partitions hold ``LARGE_ROWS``, keeps its own."""
    return partitions if partitions > SMALL_PARTITIONS else min(partitions, STEP_PARTITIONS)


def for_steps(df: DataFrame) -> DataFrame:
    """``df`` with its partitions put together for such a learner; no row moves."""
    partitions = df.rdd.getNumPartitions()
    return df.coalesce(step_partitions(partitions)) if step_partitions(partitions) < partitions else df


def spread(df: DataFrame, split_bytes: int = 256 * 1024) -> DataFrame:
    """Use more cores for compute-heavy work on a table of few file splits.

    A file of a few MB is one split, hence one task, however dear each row is. The
    check is on the planner's size estimate; a table with enough splits is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    tasks = min(cores, -(-size // split_bytes))
    return df.repartition(tasks) if tasks > 1 and size < cores * _FILE_SPLIT_BYTES else df


_FILE_SPLIT_BYTES = 4 * 1024 * 1024
