"""Session settings and staging of intermediate tables."""

from __future__ import annotations

import gc
import os
import pickle
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("starlens")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def sent(spark: SparkSession, value):
    """A broadcast of a value of this package's classes, for ``received`` in the workers."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(broadcast):
    return pickle.loads(broadcast.value)


def staging_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a folder of one machine would be lost with it, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="starlens-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def staging_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the staging root."""
    return "/".join([staging_root(spark), "starlens", f"{name}-{uuid.uuid4().hex}"])


def stage(df: DataFrame, name: str, schema=None) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, survives lost executors and gives every later pass a
    column-pruned Parquet scan instead of a recomputation.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def unstage(staged: DataFrame) -> None:
    """Delete a staged table that no later step reads, and have Spark drop the shuffle files that nothing refers to any more.

    Spark drops them when the driver's JVM happens to collect its garbage, which may be long after a step that shuffled all texts.
    """
    spark = staged.sparkSession
    for file in staged.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if "/starlens/" in folder.toString():
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    drop_shuffles(spark)


def drop_shuffles(spark: SparkSession) -> None:
    gc.collect()
    spark._jvm.System.gc()


def driver_tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(os.path.join(folder, f"{name}.parquet")) for name in names]
