"""Intermediate rows in the shared checkpoint folder: cut lineages, and staged files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> None:
    """Only where the setting is absent and the master is local (tests, a laptop) is a local folder chosen."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local"):
            raise RuntimeError("a cluster needs spark.checkpoint.dir, a folder that its machines share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="tidemark-ckpt-"))


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder of ``spark.checkpoint.dir``.

    The shuffle files that led to the checkpoint are of no more use, so Spark is told to drop them when it is written.
    Broadcasts that nothing refers to leave the executors' memory only when the driver collects garbage, which a
    driver with little to do puts off for long, so that is asked for.
    """
    spark = df.sparkSession
    checkpoint_folder(spark)
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        return df.checkpoint()
    finally:
        spark.conf.set(_CLEAN, before)
        spark._jvm.System.gc()


_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


class Staged:
    """Rows written as Parquet to the shared checkpoint folder, and removed by ``drop`` once they are of no more use.

    ``apart`` names a boolean column whose two values go to folders of their own, so that one of them can be dropped;
    a task writes both at once, without a sort.
    """

    def __init__(self, df: DataFrame, apart: str | None = None, codec: str = "snappy"):
        spark = df.sparkSession
        checkpoint_folder(spark)
        self.spark, self.path = spark, f"{spark.sparkContext.getCheckpointDir()}/staged-{uuid.uuid4().hex}"
        writer = df.write.option("compression", codec)
        before = spark.conf.get(_WRITERS, "0")
        spark.conf.set(_WRITERS, "2" if apart else before)
        try:
            (writer.partitionBy(apart) if apart else writer).parquet(self.path)
        finally:
            spark.conf.set(_WRITERS, before)
        self.df = spark.read.schema(df.schema).parquet(self.path)

    def drop(self, part: str | None = None) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}" if part else self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
