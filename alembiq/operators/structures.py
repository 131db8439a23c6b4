"""Fingerprints and level-3 clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parsing as p
from ..functions.hashing import token_bits
from ..functions.units import tanimoto
from ..shared import cut
from . import profile
from .canopy import BLOCK, canopies


def resolve(df: DataFrame, names: tuple[str, ...], suffixes: tuple[str, ...] = ("", "_lvl2", "_sig")) -> Column:
    """The first non-blank of the columns name+suffix that exist: names in order, exact spelling before lower case, suffixes in order."""
    have = set(df.columns)
    tried = [f"{spelt}{s}" for name in names for spelt in dict.fromkeys((name, name.lower())) for s in suffixes]
    found = [p.blank_to_null(F.col(c).cast("string")) for c in dict.fromkeys(tried) if c in have]
    return F.coalesce(*found, F.lit(None).cast("string"))


def resolve_tokens(df: DataFrame, name: str, suffixes: tuple[str, ...]) -> Column:
    """Like ``resolve`` for a list column, as an array."""
    kinds = dict(df.dtypes)
    found = []
    for s in suffixes:
        if (c := f"{name}{s}") in kinds:
            found.append(F.col(c) if kinds[c].startswith("array") else p.to_list(F.col(c)))
    return F.coalesce(*found, p.no_texts())


def expand(clusters: DataFrame) -> DataFrame:
    """One row per member; clusters without members drop out; a table with rxn_vid passes as it is."""
    if "rxn_vid" in clusters.columns:
        return clusters
    if "rxn_vids" not in clusters.columns:
        raise ValueError("clusters need rxn_vid or rxn_vids: give the table of members")
    vids = F.col("rxn_vids") if dict(clusters.dtypes)["rxn_vids"].startswith("array") else p.strict_ids(F.col("rxn_vids"))
    return clusters.withColumn("rxn_vid", F.explode(vids)).drop("rxn_vids")


def join_levels(members: DataFrame, mechanisms: DataFrame) -> DataFrame:
    """Members of level-2 clusters with their signatures, on rxn_vid; columns that both have get the suffixes _lvl2 and _sig."""
    both = (set(members.columns) & set(mechanisms.columns)) - {"rxn_vid"}
    left = members.withColumnsRenamed({c: f"{c}_lvl2" for c in both})
    return left.join(mechanisms.withColumnsRenamed({c: f"{c}_sig" for c in both}), "rxn_vid")


def features(joined: DataFrame, fp_bits: int = 128, hash_mode: str = "sha2") -> DataFrame:
    """rxn_vid, CID, MID, scaffold_key, tokens, fingerprint_bits (sorted) of each joined row."""
    unknown = lambda c: F.coalesce(c, F.lit("unknown"))
    staged = joined.select(
        F.col("rxn_vid").cast("long").alias("rxn_vid"),
        unknown(resolve(joined, ("CID", "cond_hash"))).alias("CID"),
        unknown(resolve(joined, ("MID", "cluster_id"))).alias("MID"),
        unknown(resolve(joined, ("scaffold_key",))).alias("scaffold_key"),
        resolve(joined, ("mech_sig_base",), ("_sig", "_lvl2", "")).alias("mech"),
        p.clean(resolve_tokens(joined, "event_tokens", ("", "_sig", "_lvl2"))).alias("events"),
    )
    tokens = F.array_distinct(
        F.concat(
            F.array(F.concat(F.lit("scaffold:"), F.col("scaffold_key"))),
            F.when(F.col("mech").isNull(), p.no_texts()).otherwise(F.array(F.concat(F.lit("mech:"), F.col("mech")))),
            F.transform("events", lambda x: F.concat(F.lit("event:"), x)),
        )
    )
    bits = F.array_sort(F.array_distinct(token_bits(F.col("tokens"), fp_bits, hash_mode)))
    return staged.withColumn("tokens", tokens).withColumn("fingerprint_bits", bits).drop("mech", "events")


def assign_structures(feats: DataFrame, threshold: float = 0.6, block: int = BLOCK) -> DataFrame:
    """Add SID and canopy_id."""
    found = canopies(feats, threshold, block)
    return found.withColumns(
        {"SID": F.concat(F.col("MID"), F.lit("-S"), F.col("canopy")), "canopy_id": F.concat(F.col("MID"), F.lit("-C"), F.col("canopy"))}
    ).drop("canopy")


def level3_members(assigned: DataFrame) -> DataFrame:
    """(CID, MID, SID, rxn_vid): the members of level-3 clusters one by one, which no hot cluster outgrows."""
    return assigned.select("CID", "MID", "SID", "rxn_vid")


def level3_clusters(assigned: DataFrame, arrays: bool = True) -> DataFrame:
    """One row per (CID, MID, SID): with ``arrays`` the members in order, the first three as exemplars, size."""
    key = ["CID", "MID", "SID"]
    if not arrays:
        nth = F.row_number().over(Window.partitionBy(*key).orderBy("rxn_vid"))
        first = assigned.select(*key, "rxn_vid").withColumn("nth", nth).filter("nth <= 3")
        exemplars = first.groupBy(*key).agg(F.array_sort(F.collect_list("rxn_vid")).alias("exemplar_vids"))
        return exemplars.join(assigned.groupBy(*key).agg(F.count("*").alias("cluster_size")), key)
    made = assigned.groupBy("CID", "MID", "SID").agg(F.array_sort(F.collect_list("rxn_vid")).alias("rxn_vids"))
    return made.withColumns({"exemplar_vids": F.slice("rxn_vids", 1, 3), "cluster_size": F.size("rxn_vids").cast("long")})


def ann_manifest(feats: DataFrame, m: int = 32, efc: int = 400) -> DataFrame:
    """One row per (cid, mid): its size and the index parameters."""
    sizes = feats.groupBy(F.col("CID").alias("cid"), F.col("MID").alias("mid")).agg(F.count("*").alias("size"))
    return sizes.withColumns({"m": F.lit(m), "efc": F.lit(efc)})


def vectors(feats: DataFrame) -> DataFrame:
    """The sorted bits as numbers."""
    return feats.withColumn("vector", F.transform("fingerprint_bits", lambda b: b.cast("double")))


def sampled_similarity(feats: DataFrame, rows: int = 200) -> DataFrame:
    """Tanimoto statistics over all pairs of the first ``rows`` reactions (at most rows*(rows-1)/2 pairs)."""
    first = feats.orderBy("rxn_vid").limit(rows).select("rxn_vid", "fingerprint_bits")
    a, b = first.alias("a"), first.alias("b")
    pairs = a.join(F.broadcast(b), F.col("a.rxn_vid") < F.col("b.rxn_vid"))
    score = tanimoto(F.col("a.fingerprint_bits"), F.col("b.fingerprint_bits"))
    return pairs.select(score.alias("s")).agg(
        F.count("*").alias("n_pairs"),
        F.round(F.avg("s"), 6).alias("mean"),
        F.round(F.median("s"), 6).alias("median"),
        F.round(F.min("s"), 6).alias("low"),
        F.round(F.max("s"), 6).alias("high"),
    )


def summary(feats: DataFrame) -> DataFrame:
    n = F.size("fingerprint_bits")
    return feats.agg(
        F.count("*").alias("n_rows"),
        F.round(F.avg(n), 6).alias("mean_bits"),
        F.median(n).alias("median_bits"),
        F.min(n).cast("long").alias("min_bits"),
        F.max(n).cast("long").alias("max_bits"),
        F.count_distinct("fingerprint_bits").alias("n_patterns"),
        F.count_if(n == 0).alias("n_empty"),
        F.count_distinct("CID", "MID").alias("n_groups"),
        F.count_if(F.col("scaffold_key") == "unknown").alias("n_unknown_scaffold"),
    )


def _events(feats: DataFrame) -> Column:
    return F.filter("tokens", lambda t: t.startswith("event:"))


def usage(feats: DataFrame, limit: int = 5) -> DataFrame:
    """The commonest tokens, events, mechanisms, scaffolds and groups."""
    wanted = {
        "token": F.col("tokens"),
        "event": _events(feats),
        "mechanism": F.filter("tokens", lambda t: t.startswith("mech:")),
        "scaffold_key": F.col("scaffold_key"),
        "group": F.concat_ws("|", "CID", "MID"),
    }
    return profile.usage(feats, wanted, limit)


def spread(feats: DataFrame) -> DataFrame:
    """Bits, tokens and events of a reaction."""
    return profile.spread(feats, {"bits": F.size("fingerprint_bits"), "tokens": F.size("tokens"), "events": F.size(_events(feats))})


def warnings(feats: DataFrame) -> DataFrame:
    """(warning): signs that fingerprints tell nothing apart."""
    found = feats.agg(
        F.count("*").alias("n"),
        F.count_distinct("fingerprint_bits").alias("patterns"),
        F.count_if(F.size("fingerprint_bits") == 0).alias("empty"),
        F.count_if(F.size(_events(feats)) == 0).alias("silent"),
    )
    said = F.array_compact(
        F.array(
            F.when((F.col("n") > 1) & (F.col("patterns") <= 1), "all fingerprints are equal"),
            F.when(F.col("empty") > 0, F.concat(F.col("empty").cast("string"), F.lit(" fingerprints are empty"))),
            F.when(F.col("silent") > 0, F.concat(F.col("silent").cast("string"), F.lit(" reactions have no event"))),
        )
    )
    return found.select(F.explode(said).alias("warning"))


def stand_in_search(feats: DataFrame, k: int = 5) -> DataFrame:
    """(query, place): a stand-in index that answers every query of a group with places 0 .. min(k, size)-1, whatever the query.

    ``canopy.search`` gives the nearest rows.

    Sizes are counted and joined, not taken over a window, so that no group
    meets in one task.
    """
    feats = cut(feats.select("rxn_vid", "CID", "MID"), "search")
    sizes = feats.groupBy("CID", "MID").agg(F.count("*").alias("n"))
    sized = feats.join(sizes, ["CID", "MID"]).select(F.col("rxn_vid").alias("query"), "n")
    return sized.select("query", F.explode(F.sequence(F.lit(0), F.least(F.lit(k), F.col("n")).cast("int") - 1)).alias("place"))
