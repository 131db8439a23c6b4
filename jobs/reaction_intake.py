"""Incremental intake of raw reactions: ``python -m jobs.reaction_intake --config jobs/reaction_intake.json``.

Raw reactions arrive in ever more orders. A run takes those whose order lies
beyond the mark of the last finished load, normalizes them, sets failures
aside, and keeps reactions that no earlier load has, with their condition keys.

Tables under ``output``, each partitioned by ``load``:

- ``reactions``: a reaction's hash, condition and first source;
- ``provenance``: every source of every reaction, one by one;
- ``failures``: rejected rows with the reason;
- ``loads``: one row for a finished load: the mark it reached and its counts.

``loads`` is written last. A run that dies before has no load of its own: the
next one takes the same rows again under the same number and replaces the
partitions. So any number of runs over the same input leave the same tables,
and loads over growing input leave those of one load over all. Rows that come
later with an order below the mark are not seen; orders must grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alembiq.operators import conditions, normalize
from alembiq.plans.reaction_view import reaction_view
from alembiq.shared import cut

from .common import command, log, read_or_empty, write_partitions

REACTIONS = "ord long, rxn_id string, reaction_hash_v1 string, cond_hash string, temp_K_bin string, solvent_key string, catalyst_key string, source string, load long"
PROVENANCE = "reaction_hash_v1 string, ord long, rxn_id string, load long"
FAILURES = "ord long, rxn_id string, source string, failure string, load long"
LOADS = "after long, upto long, n_rows long, n_reactions long, n_failures long, load long"
KEPT = ("ord", "rxn_id", "reaction_hash_v1", "cond_hash", "temp_K_bin", "solvent_key", "catalyst_key", "source")


def take(spark: SparkSession, raw: DataFrame, output: str) -> int:
    """Load the rows of ``raw`` whose ``ord`` lies beyond the mark; the number of rows taken."""
    done = read_or_empty(spark, f"{output}/loads", LOADS).agg(F.max("upto").alias("mark"), F.max("load").alias("load"), F.sum("n_rows").alias("n")).first()
    mark, load, before = done["mark"], 0 if done["load"] is None else done["load"] + 1, done["n"] or 0
    new = raw.filter("ord is not null") if mark is None else raw.filter(F.col("ord") > mark)
    table = normalize.normalized_table(new, ordinal="ord", first_place=before)
    seen = table.agg(F.count("*").alias("n"), F.max("ord").alias("upto")).first()
    log.info("load %d: read %d rows beyond %s", load, seen["n"], mark)
    if not seen["n"]:
        return 0
    good, _ = normalize.split_failures(table)
    # of every hash the least source: only hashes and orders are shuffled, and combined before that
    least = good.groupBy("reaction_hash_v1").agg(F.min("ord").alias("ord"))
    earlier = read_or_empty(spark, f"{output}/reactions", REACTIONS).filter(F.col("load") < load).select("reaction_hash_v1")
    fresh = least.join(earlier, "reaction_hash_v1", "left_anti")
    rows = good.join(fresh, ["reaction_hash_v1", "ord"], "left_semi").withColumn("rxn_vid", F.col("ord"))
    keyed = cut(conditions.condition_keys(rows, keep=("ord", "rxn_id", "reaction_hash_v1", "source")).select(*KEPT), "intake")
    failed = table.filter(F.size("failures") > 0).select("ord", "rxn_id", "source", F.explode("failures").alias("failure"))
    at = F.lit(load).cast("long").alias("load")
    write_partitions(keyed.select("*", at), f"{output}/reactions", "load")
    write_partitions(normalize.provenance_rows(good).select("*", at), f"{output}/provenance", "load")
    write_partitions(failed.select("*", at), f"{output}/failures", "load")
    counts = (mark, seen["upto"], seen["n"], keyed.count(), failed.select("ord").distinct().count(), load)
    write_partitions(spark.createDataFrame([counts], LOADS).coalesce(1), f"{output}/loads", "load")
    log.info("load %d: %d reactions, %d failed rows, mark %s", load, counts[3], counts[4], counts[1])
    return seen["n"]


def reaction_intake(spark: SparkSession, tables: str, output: str) -> int:
    """Take what is new in the order tables in ``tables``."""
    return take(spark, reaction_view(spark, tables), output)


def current(spark: SparkSession, output: str) -> DataFrame:
    """The output as it stands: a row for each reaction, with its number of sources, and for each failure."""
    reactions = read_or_empty(spark, f"{output}/reactions", REACTIONS)
    copies = read_or_empty(spark, f"{output}/provenance", PROVENANCE).groupBy("reaction_hash_v1").agg(F.count("*").alias("copies"))
    text = F.lit(None).cast("string")
    kept = reactions.join(copies, "reaction_hash_v1").select(
        F.lit("reaction").alias("kind"), "ord", "rxn_id", "reaction_hash_v1", "cond_hash", "copies", text.alias("failure"), "load"
    )
    failed = read_or_empty(spark, f"{output}/failures", FAILURES).select(
        F.lit("failure").alias("kind"), "ord", "rxn_id", text.alias("reaction_hash_v1"), text.alias("cond_hash"), F.lit(None).cast("long").alias("copies"), "failure", "load"
    )
    return kept.unionByName(failed)


if __name__ == "__main__":
    command(reaction_intake, __doc__)
