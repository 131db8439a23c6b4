"""Mechanism signatures and level-2 clusters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chemistry as chem
from ..functions import parsing as p
from ..functions.hashing import hex_digest, key_hash, token_hash
from ..shared import cut
from . import profile
from .quantiles import quantiles


#: What a signature follows from.
SIDES = ("reactants_canonical", "products_canonical", "role_main_substrate")


def signatures(keys: DataFrame, reactions: DataFrame, hash_mode: str = "sha2") -> DataFrame:
    """Signature of every reaction that has a condition key.

    Sides that differ in their characters are ``mapped``: tokens are the
    character gains and losses. Others are ``unmapped``: tokens name the
    molecules.
    """
    return signed(keys.select("rxn_vid", "cond_hash").join(reactions.select("rxn_vid", *SIDES), "rxn_vid"), ("rxn_vid", "cond_hash"), hash_mode)


def distinct_signatures(keyed: DataFrame, hash_mode: str = "sha2") -> DataFrame:
    """``signatures`` of reactions with their cond_hash in one table; equal sides and substrates are signed once.

    The distinct sides are a table first, so that nothing of the work moves
    below ``distinct``, and are dealt out again, as a few small files are read
    by few tasks, whatever their rows cost.
    """
    keyed = keyed.select("rxn_vid", "cond_hash", *SIDES)
    sides = cut(keyed.select(*SIDES).distinct(), "sides")
    made = cut(signed(sides.repartition(*SIDES), SIDES, hash_mode), "signed")
    same = reduce(Column.__and__, [keyed[c].eqNullSafe(made[c]) for c in SIDES])
    return keyed.join(made, same).select("rxn_vid", "cond_hash", *[c for c in made.columns if c not in SIDES])


def signed(both: DataFrame, keep: tuple[str, ...], hash_mode: str = "sha2") -> DataFrame:
    """The columns ``keep`` of rows with ``SIDES``, and their signature."""
    sides = both.withColumns({"ca": p.characters(F.col("reactants_canonical")), "cb": p.characters(F.col("products_canonical"))})
    delta = sides.withColumn("events", p.multiset_delta(F.col("ca"), F.col("cb")))
    named = lambda c, prefix: F.array_sort(F.transform(p.clean(F.col(c)), lambda x: F.concat(F.lit(prefix), x)))
    plain = F.concat(named("reactants_canonical", "R:"), named("products_canonical", "P:"))
    mapped = F.size("events") > 0
    tokens = delta.select(
        *keep,
        F.when(mapped, F.col("events")).otherwise(plain).alias("event_tokens"),
        F.when(mapped, "mapped").otherwise("unmapped").alias("signature_type"),
        chem.main_scaffold(F.col("reactants_canonical"), F.col("products_canonical"), F.col("role_main_substrate")).alias("scaffold_key"),
    )
    mapped = F.col("signature_type") == "mapped"
    t = F.col("event_tokens")
    starts = lambda s: F.when(mapped, F.size(F.filter(t, lambda x: x.startswith(s)))).otherwise(0)
    unmapped = hex_digest(F.array_join(F.when(F.size(t) > 0, t).otherwise(F.array(F.lit("noop"))), "|"), hash_mode)
    out = tokens.select(
        *keep,
        F.when(mapped, token_hash("base", t, hash_mode)).otherwise(unmapped).alias("mech_sig_base"),
        F.when(mapped, token_hash("r1", t, hash_mode)).alias("mech_sig_r1"),
        F.when(mapped, token_hash("r2", t, hash_mode)).alias("mech_sig_r2"),
        "signature_type",
        "event_tokens",
        starts("+O").alias("redox_events"),
        F.lit(0).alias("stereo_events"),
        starts("+C").alias("ring_events"),
        "scaffold_key",
        chem.families(t).alias("families"),
    )
    out = out.withColumn("coarse_key", chem.coarse_key(F.col("families"), F.col("scaffold_key"))).drop("families")
    out = out.withColumn("coarse_text", chem.coarse_text(F.col("coarse_key")))
    return out.withColumn("coarse_key_hash", key_hash(F.col("coarse_text"), chem.coarse_json(F.col("coarse_key")), hash_mode))


def assign_clusters(sigs: DataFrame) -> DataFrame:
    """Add cluster_id: the rank of the coarse key's text within its condition.

    Ranks are taken over the distinct keys, so that no condition's reactions
    meet in one task, and joined back. Both sides read the signatures, so they
    are a table first.
    """
    sigs = cut(sigs, "signatures")
    keys = sigs.select("cond_hash", "coarse_text").distinct()
    place = F.row_number().over(Window.partitionBy("cond_hash").orderBy("coarse_text"))
    named = keys.select("cond_hash", "coarse_text", F.concat_ws("-", "cond_hash", place).alias("cluster_id"))
    # small files of many rows: Spark would broadcast all signatures to the few tasks of the keys
    return sigs.join(named.hint("merge"), ["cond_hash", "coarse_text"])


def level2_members(sigs: DataFrame) -> DataFrame:
    """(CID, MID, rxn_vid): the members of level-2 clusters one by one, which no hot cluster outgrows."""
    return sigs.select(F.col("cond_hash").alias("CID"), F.col("cluster_id").alias("MID"), "rxn_vid")


def level2_clusters(sigs: DataFrame, arrays: bool = True) -> DataFrame:
    """One row per cluster: counts of base signatures, the commonest (first seen among equals), with ``arrays`` the members in order."""
    vids = [F.collect_list("rxn_vid").alias("vids")] if arrays else []
    bases = sigs.groupBy("cond_hash", "cluster_id", "coarse_text", "coarse_key_hash", "mech_sig_base").agg(
        F.count("*").alias("n"), F.min("rxn_vid").alias("first"), *vids, F.first("coarse_key").alias("k")
    )
    listed = [F.array_sort(F.flatten(F.collect_list("vids"))).alias("rxn_vids")] if arrays else []
    return bases.groupBy("cond_hash", "cluster_id", "coarse_text", "coarse_key_hash").agg(
        F.max_by("mech_sig_base", F.struct(F.col("n"), -F.col("first"))).alias("mech_sig_base"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("mech_sig_base", "n")))).alias("mech_sig_base_counts"),
        F.first("k").alias("coarse_key"),
        F.sum("n").alias("rxn_count"),
        *listed,
    )


def percentiles(df: DataFrame, value: str, points: tuple[int, ...] = (10, 25, 50, 75, 90)) -> DataFrame:
    """(p, value): exact percentiles with linear interpolation; points outside 0 to 100 are left out, no row for no value."""
    good = [x for x in points if 0 <= x <= 100]
    found = quantiles(df, [], value, [x / 100 for x in good]).withColumnRenamed("q", "v")
    pairs = F.arrays_zip(F.array(*[F.lit(x) for x in good]).alias("p"), F.col("v"))
    return found.select(F.explode(pairs).alias("x")).select(F.col("x.p").alias("p"), F.col("x.v").alias("value"))


def summary(sigs: DataFrame) -> DataFrame:
    n_tokens = F.size("event_tokens")
    return sigs.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("signature_type") == "mapped").alias("n_mapped"),
        F.count_distinct("cond_hash").alias("n_conditions"),
        F.count_distinct("mech_sig_base").alias("n_bases"),
        F.count_distinct("scaffold_key").alias("n_scaffolds"),
        F.round(F.avg(n_tokens), 6).alias("mean_tokens"),
        F.median(n_tokens).alias("median_tokens"),
        F.count_if(F.col("redox_events") > 0).alias("n_redox"),
        F.count_if(F.col("ring_events") > 0).alias("n_ring"),
        F.count_if(F.col("stereo_events") > 0).alias("n_stereo"),
    )


def coarse_usage(sigs: DataFrame) -> DataFrame:
    """Per coarse key: reactions, and conditions it appears in."""
    return sigs.groupBy("coarse_text").agg(F.count("*").alias("n"), F.count_distinct("cond_hash").alias("n_conditions"))


def single_condition_keys(sigs: DataFrame, limit: int = 5) -> DataFrame:
    """The commonest coarse keys that occur in one condition only."""
    return coarse_usage(sigs).filter("n_conditions = 1").select("coarse_text", "n").orderBy(F.desc("n"), "coarse_text").limit(limit)


def largest_clusters(clusters: DataFrame, limit: int = 5) -> DataFrame:
    return clusters.select("cluster_id", "coarse_text", "rxn_count").orderBy(F.desc("rxn_count"), "cluster_id").limit(limit)


def usage(sigs: DataFrame, clusters: DataFrame, limit: int = 5) -> DataFrame:
    """The commonest types, base signatures, tokens, scaffolds, coarse keys and families; the conditions with most clusters."""
    wanted = {
        "signature_type": F.col("signature_type"),
        "mech_sig_base": F.col("mech_sig_base"),
        "event_token": F.col("event_tokens"),
        "scaffold_key": F.col("scaffold_key"),
        "coarse_key": F.col("coarse_text"),
        "scaffold_family": F.col("coarse_key.scaffold"),
    }
    return profile.usage(sigs, wanted, limit).unionByName(profile.usage(clusters, {"clusters_of_condition": F.col("cond_hash")}, limit))


def spread(sigs: DataFrame, clusters: DataFrame) -> DataFrame:
    """Tokens of a reaction; reactions and base signatures of a cluster."""
    by_cluster = {"rxn_count": F.col("rxn_count"), "n_bases": F.size("mech_sig_base_counts")}
    return profile.spread(sigs, {"event_tokens": F.size("event_tokens")}).unionByName(profile.spread(clusters, by_cluster))


def family_sizes(clusters: DataFrame) -> DataFrame:
    """Per scaffold family: clusters, and their mean size."""
    by = clusters.groupBy(F.col("coarse_key.scaffold").alias("family"))
    return by.agg(F.count("*").alias("n_clusters"), F.round(F.avg("rxn_count"), 6).alias("mean_size"))


def event_family_sizes(clusters: DataFrame) -> DataFrame:
    """Per event family: clusters, and their mean size."""
    each = clusters.select("rxn_count", F.explode(F.array_distinct(F.col("coarse_key.families.family"))).alias("family"))
    return each.groupBy("family").agg(F.count("*").alias("n_clusters"), F.round(F.avg("rxn_count"), 6).alias("mean_size"))
