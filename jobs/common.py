"""What both jobs share: reading a table that may not be there yet, partitioned writes, and the command line."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger("alembiq.jobs")


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or no rows of its schema where nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that ``df`` has rows of; others stay. The mode is the write's own, no setting of the session."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    log.info("wrote %s by %s", path, ", ".join(by))


def command(run: Callable[..., Any], description: str | None, args: list[str] | None = None) -> None:
    """``--config FILE`` names a JSON object of ``run``'s arguments, ``--set name=value`` overrides one; creates the session and stops it."""
    parser = argparse.ArgumentParser(description=description)
    parser.add_argument("--config", required=True)
    parser.add_argument("--set", action="append", default=[], metavar="NAME=VALUE")
    given = parser.parse_args(args)
    with open(given.config, encoding="utf-8") as f:
        options = json.load(f)
    for name, _, value in (x.partition("=") for x in given.set):
        options[name] = int(value) if isinstance(options.get(name), int) else value
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(f"alembiq-{run.__name__}").getOrCreate()
    try:
        run(spark, **options)
    finally:
        spark.stop()
