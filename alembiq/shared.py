"""Lineage cuts in the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset and the session is local (tests), one of our own.

    A cluster without the setting is an error: its executors share no folder of
    this machine, so that rows written there would be lost.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='alembiq-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base


#: Whether Spark removes an execution's shuffle files at its end, and not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, name: str, clean: bool = False, **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage once and for all: the files outlive any executor, the
    work before them runs once, and values that depend on a plan (partition
    order, for one) are fixed. The folder is removed when the driver ends.
    With ``clean`` the shuffle files of writing it go at once. Options are the Parquet writer's.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/alembiq/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    if clean:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if clean and before is None:
            spark.conf.unset(CLEANUP)
        elif clean:
            spark.conf.set(CLEANUP, before)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)
