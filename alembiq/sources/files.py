"""Files in and out."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import cut


#: Column metadata that holds the number of buckets of ``write_keyed``.
BUCKETS = "alembiq.buckets"


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """CSV (all columns text unless a schema is given), JSON document, JSON lines or Parquet, by suffix.

    Parquet that ``write_keyed`` wrote is read by its buckets.
    """
    suffix = PurePosixPath(path.rstrip("/")).suffix.lower()
    reader = spark.read.schema(schema) if schema else spark.read
    if suffix == ".csv":
        return reader.csv(path, header=True)
    if suffix == ".json":
        return reader.json(path, multiLine=True)
    if suffix == ".jsonl":
        return reader.json(path)
    if suffix in (".parquet", ".pq"):
        return reader.parquet(path) if schema else by_buckets(spark, path, reader.parquet(path))
    raise ValueError(f"unsupported input format: {suffix or path}")


def read_ordered(spark: SparkSession, path: str, name: str = "ord") -> DataFrame:
    """``read_table`` with the input order in column ``name``, a long: files by name, rows as they stand in them.

    Spark packs splits of files into tasks by size, so that the order of its
    tasks is not the input's. A row's place in a Parquet file is metadata; in
    other formats it is the byte its split starts at and its place in the split,
    for which the rows are made a table first. Names of files are ranked and
    broadcast: the driver has listed them to plan the scan. A folder's files are
    in the order of their paths; columns of that name in the input are replaced.
    """
    df = read_table(spark, path)
    df = df.drop(*[c for c in df.columns if c.lower() == name.lower()])
    own = df.columns
    where = F.col("_metadata.file_path").alias("_file")
    if PurePosixPath(path.rstrip("/")).suffix.lower() in (".parquet", ".pq"):
        placed = df.select(*own, where, F.col("_metadata.row_index").alias("_place"))
    else:
        id_ = F.monotonically_increasing_id().alias("_id")
        fixed = cut(df.select(*own, where, F.col("_metadata.file_block_start").alias("_start"), id_), "ordered")
        first = fixed.groupBy("_file", "_start").agg(F.min("_id").alias("_first"))
        # rows of a split are fewer than its bytes, so that places of one split end before the next
        placed = fixed.join(first, ["_file", "_start"]).withColumn("_place", F.col("_start") + F.col("_id") - F.col("_first")).drop("_start", "_id", "_first")
    files = placed.select("_file").distinct()
    ranks = files.withColumn("_rank", F.row_number().over(Window.orderBy("_file")))
    at = (F.shiftleft(F.col("_rank").cast("long"), 42) + F.col("_place")).alias(name)
    return placed.join(F.broadcast(ranks), "_file").select(*own, at)


def sample(df: DataFrame, key: str, rows: int = 1000) -> DataFrame:
    """The ``rows`` rows of the least key: a sample that tables share."""
    return df.orderBy(key).limit(rows)


def interchange(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for exchange with tools that expect flat files."""
    nested = ("array", "map", "struct")
    return df.select(*[F.to_json(c).alias(c) if t.startswith(nested) else F.col(c) for c, t in df.dtypes])


@contextmanager
def case_sensitive(spark: SparkSession) -> Iterator[None]:
    """Read and write tables whose column names differ in case only."""
    name = "spark.sql.caseSensitive"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_table(df: DataFrame, path: str, *partition_by: str, order: tuple[str, ...] = ()) -> None:
    """Parquet with the declared schema, also when empty, sorted over all files by ``order``; Spark adds _SUCCESS."""
    writer = (df.orderBy(*order) if order else df).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_keyed(df: DataFrame, path: str, key: str, buckets: int = 0) -> None:
    """Parquet in ``buckets`` files by the hash of ``key`` (0: as many as the session's shuffle partitions), each sorted by it.

    Tables of one key and number of buckets join and group on it without an
    exchange. The number is kept as metadata of the key column, so that
    ``read_table`` finds it in any session, without a metastore.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = df.withMetadata(key, {BUCKETS: n})
    name = f"alembiq_{uuid.uuid4().hex}"
    writer = marked.repartition(n, key).write.format("parquet").mode("overwrite").option("path", path)
    try:
        writer.bucketBy(n, key).sortBy(key).saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if not spark.read.schema(df.schema).parquet(path).inputFiles():
        write_table(df.limit(0), path)  # buckets without rows have no file that keeps the schema


def by_buckets(spark: SparkSession, path: str, plain: DataFrame) -> DataFrame:
    """``plain``, the table at ``path``, as Spark's bucketed table if ``write_keyed`` wrote it.

    Tables made from a keyed one may carry its metadata on; their files' names
    have no bucket, and they are read as they are.
    """
    keys = [f for f in plain.schema if BUCKETS in f.metadata]
    if len(keys) != 1:
        return plain
    n = keys[0].metadata[BUCKETS]
    found = [re.search(r"_(\d+)\.[^/]*$", name) for name in plain.inputFiles()]
    if not found or not all(x and int(x[1]) < n for x in found):
        return plain
    name, key = f"alembiq_{uuid.uuid4().hex}", keys[0].name.replace("`", "``")
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({plain.schema.toDDL()}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {n} BUCKETS LOCATION '{place}'"
    )
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the files stay, and so does what was read


def write_failures(df: DataFrame, path: str) -> bool:
    """Write failures as Parquet, nothing if there are none; whether it wrote."""
    if df.isEmpty():
        return False
    write_table(interchange(df), path)
    return True


def json_lines(df: DataFrame) -> DataFrame:
    """One JSON object a row, keys in order, null keys left out."""
    return df.select(F.to_json(F.struct(*sorted(df.columns))).alias("value"))


def write_jsonl(df: DataFrame, path: str) -> None:
    json_lines(df).write.mode("overwrite").text(path)
