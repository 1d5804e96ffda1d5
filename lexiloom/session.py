"""Session settings used by the bench and the tests, and lineage cutting."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Checkpoint folder of local sessions that name none; Spark makes a folder of its own below it.
LOCAL_CHECKPOINTS = os.environ.get("LEXILOOM_CHECKPOINTS", "/tmp/lexiloom-checkpoints")


def local_session(cpus: int | str = "*", app: str = "lexiloom", **conf: str) -> SparkSession:
    """A local session for tests and bench; a cluster brings its own session."""
    n = "8" if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", n)
        .config("spark.sql.adaptive.enabled", "true")
        # Local data is small but costly per row: keep the cores busy.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``. Where nothing is set, a
    local session gets ``LOCAL_CHECKPOINTS``; any other master must name one,
    because a folder of one machine does not outlive an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = LOCAL_CHECKPOINTS
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Words of a row group stay numbers of its dictionary up to this many bytes of different ones.
DICTIONARY_BYTES = 8 << 20


def cut_to_columns(df: DataFrame) -> DataFrame:
    """Like ``cut_lineage`` for wide rows that are read several times, some columns at a time:
    written as Parquet below the shared folder, and deleted when the application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/columns-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    df.write.option("parquet.dictionary.page.size", DICTIONARY_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
