"""How coherent the sources of a text corpus are and what they share: ``python -m jobs.source_overlap --config jobs/source_overlap.json``.

Whoever fuses records of several vendors first asks which of them repeat
themselves and each other. Per language and source the job counts rows without
text, distinct texts and openings (first lines), the entropy of the openings
and the share of the commonest; per pair of sources, the texts and openings
they share.

Documents arrive as files. A file stream reads each file once, its texts become
counts by hash, and a run ends when all files there are read. Tables under
``output``:

- ``counts``, by ``batch`` and ``lang``: rows of a batch by source, kind and id;
- ``sources``, by ``lang``: one row for a source in a language;
- ``pairs``, by ``lang``: one row for two sources in a language and a kind
  (text or opening): shared ids, and the sum of the smaller counts;
- ``reported``: the last batch that both reports include.

The stream's checkpoint fixes the files of a batch, and a batch replaces its own
partitions, so that one which is repeated counts once. The reports of the
languages that later batches touch are made again from the counts and replace
their partitions; ``reported`` is written last, so that a run that dies before
has its reports made by the next. A rerun without new files changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alembiq.functions import parsing as p
from alembiq.operators import coherence, fusion
from alembiq.shared import cut

from .common import command, log, read_or_empty, write_partitions

COUNTS = "source string, kind string, id string, n long, batch long, lang string"
SOURCES = (
    "source string, n_rows long, n_missing long, n_texts long, n_openings long, opening_entropy double, top_opening_share double,"
    " n_shared_texts long, n_shared_openings long, lang string"
)
PAIRS = "kind string, source string, target string, n_shared long, weight long, lang string"
REPORTED = "batch long"
KEY = ["lang", "source"]


def count_ids(documents: DataFrame) -> DataFrame:
    """lang, source, kind, id, n: rows by the hash of their text and of its first line; kind missing, with an empty id, for blank texts."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c)
    text = F.when(p.blank_to_null(F.col("text")).isNotNull(), F.col("text"))
    item = lambda kind, id_: F.struct(F.lit(kind).alias("kind"), id_.alias("id"))
    some = F.array(item("text", F.sha2(text, 256)), item("opening", F.sha2(F.substring_index(text, "\n", 1), 256)))
    items = F.when(text.isNotNull(), some).otherwise(F.array(item("missing", F.lit(""))))
    return documents.select(known("lang"), known("source"), F.explode(items).alias("x")).groupBy(*KEY, "x.kind", "x.id").agg(F.count("*").alias("n"))


def report(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sources, pairs) from lang, source, kind, id, n with one row for each id of a source."""
    kinds = {c: F.coalesce(F.sum(F.when(F.col("kind") == k, v)), F.lit(0)) for c, k, v in (("texts_n", "text", F.col("n")), ("n_missing", "missing", F.col("n")), ("n_texts", "text", F.lit(1)))}
    size = counts.groupBy(*KEY).agg(*[v.alias(c) for c, v in kinds.items()])
    openings = coherence.counted_metrics(counts.filter("kind = 'opening'"), KEY).drop("rxn_count")
    # sources are conditions, openings and texts what conditions can share; languages don't mix
    held = counts.filter("kind <> 'missing'").select("kind", F.concat_ws("|", "lang", "id").alias("shared_id"), F.col("source").alias("CID"), "n")
    lang = F.substring_index("shared_id", "|", 1).alias("lang")
    several = held.groupBy("kind", "shared_id").agg(F.count("*").alias("m")).filter("m > 1").drop("m")
    own = held.join(several, ["kind", "shared_id"], "left_semi").groupBy(lang, F.col("CID").alias("source")).agg(
        F.count_if(F.col("kind") == "text").alias("n_shared_texts"), F.count_if(F.col("kind") == "opening").alias("n_shared_openings")
    )
    named = {"base_diversity": "n_openings", "base_entropy": "opening_entropy", "top1_base_share": "top_opening_share"}
    found = size.join(openings, KEY, "left").join(own, KEY, "left").withColumnsRenamed(named).withColumn("n_rows", F.col("texts_n") + F.col("n_missing"))
    sources = found.fillna(0)
    pairs = fusion.pairs_of(held).groupBy(lang, "kind", "source", "target").agg(F.count("*").alias("n_shared"), F.sum("weight").alias("weight"))
    return sources, pairs


def source_overlap(spark: SparkSession, documents: str, output: str, max_files: int = 1000) -> int:
    """Read the files of the documents table (Parquet) that no run has read, ``max_files`` in a batch, and bring the reports up to date; the batches read."""

    documents = documents.rstrip("/")

    def keep(batch: DataFrame, number: int) -> None:
        write_partitions(count_ids(batch).withColumn("batch", F.lit(number).cast("long")), f"{output}/counts", "batch", "lang")

    schema = spark.read.parquet(documents).schema
    named = f"{documents[:-1]}[{documents[-1]}]"  # a pattern of one path: Spark streams a table that is a single file by a pattern only
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(named).select("lang", "source", F.col("text").cast("string"))
    run = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{output}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    last = read_or_empty(spark, f"{output}/reported", REPORTED).agg(F.max("batch").alias("b")).first()["b"]
    counts = read_or_empty(spark, f"{output}/counts", COUNTS)
    new = counts if last is None else counts.filter(F.col("batch") > last)
    batches = new.select("batch").distinct().orderBy("batch").collect()
    rows = new.filter("kind <> 'opening'").agg(F.sum("n").alias("n")).first()["n"] or 0
    log.info("read %d rows of %s in %d batches", rows, documents, len(batches))
    if not batches:
        return 0
    # of the languages that new batches touch, all batches count
    touched = counts.join(new.select("lang").distinct(), "lang", "left_semi")
    whole = cut(touched.groupBy(*KEY, "kind", "id").agg(F.sum("n").alias("n")), "overlap")
    for name, df, schema in zip(("sources", "pairs"), report(whole), (SOURCES, PAIRS), strict=True):
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], schema).schema])
        write_partitions(typed, f"{output}/{name}", "lang")
    spark.createDataFrame([(batches[-1]["batch"],)], REPORTED).coalesce(1).write.mode("append").parquet(f"{output}/reported")
    return len(batches)


def current(spark: SparkSession, output: str) -> DataFrame:
    """The output as it stands, both reports as one table: rows of ``sources`` have kind source."""
    sources = read_or_empty(spark, f"{output}/sources", SOURCES).withColumn("kind", F.lit("source"))
    pairs = read_or_empty(spark, f"{output}/pairs", PAIRS)
    return sources.unionByName(pairs, allowMissingColumns=True)


if __name__ == "__main__":
    command(source_overlap, __doc__)
