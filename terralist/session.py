"""Session set-up shared by tests, bench and scripts, and the checkpoint rule."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def local_session(cores="*", app="terralist", shuffle_partitions=8, **conf):
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # Small data: keep all threads busy rather than merge small partitions.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # Recording the call site of every Column operation is slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the shared folder the session names.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting gets a temporary folder of its own; anything else
    without the setting is refused, because a machine-local folder would not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="terralist-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the checkpoint folder, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, count=False):
    """Write ``df`` once under the checkpoint folder and read on from there.

    A written table survives the loss of executors, runs the plan one time
    only, and gives the planner real sizes for everything built on it.  With
    ``count`` the number of rows comes along, taken as they are written.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    if not count:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["n"]


@contextmanager
def kept_partitions(spark: SparkSession):
    """What is written in here joins inputs where they lie if both were dealt out alike by
    some of the join keys; Spark otherwise deals them out again by all keys."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spread(df: DataFrame) -> DataFrame:
    """Use the whole cluster for costly row-wise work on an input in few pieces.

    A file that cannot be split is one task, and of the splits of a large Parquet file
    only those that hold the middle of a row group have rows.  So rows are counted
    where they stand; an input that lies evenly over all cores stays untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    pieces = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    most, rows = pieces.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    even = most * cores <= 2 * rows
    return df if rows and even else df.repartition(max(cores, df.rdd.getNumPartitions()))
