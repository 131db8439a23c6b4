"""The queries over the driver tables: each operator of the five phases and of the coherence report."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsing as p
from ..operators import canopy, coherence, conditions, fusion, mechanism, normalize, structures
from ..shared import cut, shared_dir
from ..sources import files
from .oracle import ORACLE
from .reaction_view import distinct_view, reaction_view

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def query(f: Query) -> Query:
    REGISTERED[f.__name__] = f
    return f


def joined(c: str | Column, by: str = "~") -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), by)


def written(c: str) -> Column:
    """value=count;value=count"""
    return F.nullif(F.array_join(F.transform(c, lambda x: F.concat_ws("=", x["value"], x["count"].cast("string"))), ";"), F.lit(""))


def rounded(df: DataFrame, places: int = 6, *names: str) -> DataFrame:
    """Doubles rounded, negative zero as zero."""
    return df.withColumns({c: F.round(c, places) + F.lit(0.0) for c in names or [c for c, t in df.dtypes if t == "double"]})


# Stages that queries share.


def normalized(spark: SparkSession, d: str) -> DataFrame:
    raw = reaction_view(spark, d)
    return normalize.normalized_table(raw, ordinal="ord")


def reactions(spark: SparkSession, d: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return normalize.reactions(distinct_view(spark, d), ordinal="ord", keep=keep)


def sigs(spark: SparkSession, d: str) -> DataFrame:
    return mechanism.assign_clusters(mechanism.distinct_signatures(conditions.condition_keys(reactions(spark, d), keep=mechanism.SIDES)))


def clusters2(spark: SparkSession, d: str) -> DataFrame:
    return mechanism.level2_clusters(sigs(spark, d))


def feats(spark: SparkSession, d: str) -> DataFrame:
    return structures.features(sigs(spark, d))


def metrics(spark: SparkSession, d: str) -> DataFrame:
    return coherence.cluster_metrics(clusters2(spark, d))


def fused(spark: SparkSession, d: str, check: bool = False) -> tuple[DataFrame, DataFrame]:
    """(assignments, cards) of all five phases."""
    rx = reactions(spark, d, keep=("yield",))
    keys = conditions.condition_keys(rx, keep=mechanism.SIDES)
    sig = cut(mechanism.assign_clusters(mechanism.distinct_signatures(keys)), "clustered")
    assigned = cut(structures.assign_structures(structures.features(sig)), "structures")
    levels = conditions.level1_members(keys), mechanism.level2_members(sig), structures.level3_members(assigned)
    merged = cut(fusion.merge_assignments(*levels, check=check), "assignments")
    return merged, fusion.cluster_cards(merged, assigned, sig, rx)


# Phase 0.


@query
def reaction_view_(spark, d):
    return reaction_view(spark, d)


REGISTERED["reaction_view"] = REGISTERED.pop("reaction_view_")


@query
def split_entities(spark, d):
    raw = reaction_view(spark, d)
    return raw.select("ord", *[joined(p.split_entities(F.col(c))).alias(c) for c in ("reactants", "products")])


@query
def parse_reaction_string(spark, d):
    raw = reaction_view(spark, d).select("ord", p.parse_reaction(F.col("rxn_smiles")).alias("x"))
    return raw.select("ord", *[joined(f"x.{c}").alias(c) for c in ("reactants", "agents", "products")])


@query
def unit_quantities(spark, d):
    return rounded(normalized(spark, d).select("ord", "temperature_K", "time_s", "pressure_Pa", "pH"), 6, "temperature_K")


@query
def present_mask(spark, d):
    return normalized(spark, d).groupBy("present_mask").agg(F.count("*").alias("n"))


@query
def spectator_move(spark, d):
    n = normalized(spark, d)
    return n.select(
        "ord",
        joined("reactants_canonical").alias("reactants"),
        joined("products_canonical").alias("products"),
        joined("agents_canonical").alias("agents"),
        joined("spectators_moved").alias("spectators"),
    )


@query
def role_scores(spark, d):
    good, _ = normalize.split_failures(normalized(spark, d))
    return good.select(F.explode("role_scores").alias("molecule", "score")).select("molecule", F.round("score", 6).alias("score")).distinct()


@query
def solvent_resolution(spark, d):
    raw = reaction_view(spark, d)
    both = raw.select("solvent").join(normalize.learn_fuzzy(raw), F.col("solvent") == F.col("solvent_text"), "left")
    found = both.select("solvent", normalize.solvents(p.tokenize(F.col("solvent")), F.col("closest")).alias("x"))
    mean = F.when(F.size("x") > 0, F.aggregate("x", F.lit(0.0), lambda a, y: a + y["confidence"]) / F.size("x")).otherwise(0.0)
    return found.groupBy("solvent", joined("x.name").alias("resolved"), mean.alias("confidence")).agg(F.count("*").alias("n"))


@query
def normalize_reactions(spark, d):
    good, _ = normalize.split_failures(normalized(spark, d))
    return good.select("ord", "reaction_hash_v1", "role_main_substrate", "present_mask", "solvent_confidence")


@query
def normalize_failures(spark, d):
    _, bad = normalize.split_failures(normalized(spark, d))
    return bad.withColumn("failures", F.array_join("failures", ","))


@query
def failure_counts(spark, d):
    return normalize.failure_counts(normalized(spark, d))


@query
def normalization_summary(spark, d):
    return normalize.summary(normalized(spark, d))


@query
def normalization_warnings(spark, d):
    return normalize.warnings(normalized(spark, d))


@query
def clashing_columns(spark, d):
    """Rows with both pH and ph, and without an id where the order is a multiple of 9."""
    raw = reaction_view(spark, d).withColumn("rxn_id", F.when(F.col("ord") % 9 != 0, F.col("rxn_id")))
    raw = raw.select("*", F.when(F.col("ord") % 2 == 0, "3").alias("pH"))
    return normalize.normalized_table(raw, ordinal="ord").select("ord", "rxn_id", "pH", F.array_join("provenance", ",").alias("provenance"))


@query
def file_order_ids(spark, d):
    """Rows without ids, written to several files: their places in the files' order are the ids."""
    raw = reaction_view(spark, d)
    path = f"{shared_dir(spark)}/alembiq/files-{uuid.uuid4().hex}.parquet"
    raw.repartitionByRange(5, "ord").sortWithinPartitions("ord").write.parquet(path)
    ordered = files.read_ordered(spark, path, "place").withColumn("rxn_id", F.lit(None).cast("string"))
    table = normalize.normalized_table(ordered, ordinal="place")
    # a row for every row, which Spark would broadcast where the columns are small in the files
    named = ordered.select("place", F.col("ord").alias("o")).hint("merge")
    return table.join(named, F.col("place") == table["ord"]).select(F.col("o").alias("ord"), "rxn_id")


@query
def unbalanced_molecules(spark, d):
    """Part names as reactants, some with an open bracket."""
    part = spark.read.parquet(f"{d}/part.parquet")
    word = F.split_part("p_name", F.lit(" "), F.lit(1))
    raw = part.select(
        F.col("p_partkey").alias("rxn_id"), F.concat(F.when(F.col("p_size") % 10 == 0, "[").otherwise(""), word).alias("reactants"), F.lit("C").alias("products")
    )
    spread = raw.repartition("rxn_id")  # a small file is one task's, whatever its rows cost
    _, bad = normalize.split_failures(normalize.normalized_table(spread, fuzzy=False))
    return bad.select("rxn_id", F.array_join("failures", ",").alias("failures"))


@query
def provenance_rows(spark, d):
    good, _ = normalize.split_failures(normalized(spark, d))
    return normalize.provenance_rows(good)


@query
def normalization_usage(spark, d):
    good, _ = normalize.split_failures(normalized(spark, d))
    return normalize.usage(good, cut(normalize.deduplicate(good), "deduplicated"))


@query
def normalization_spread(spark, d):
    return normalize.spread(normalize.split_failures(normalized(spark, d))[0])


@query
def dedup_provenance(spark, d):
    rx = normalize.phase0(reaction_view(spark, d), ordinal="ord")[0]
    return rx.select("rxn_vid", "reaction_hash_v1", "rxn_id", F.array_join("provenance", ",").alias("provenance"))


# Phase 1.


@query
def condition_keys(spark, d):
    return conditions.condition_keys(reactions(spark, d))


@query
def condition_groups(spark, d):
    return conditions.condition_sizes(normalize.distinct_table(distinct_view(spark, d), ordinal="ord"))


@query
def condition_summary(spark, d):
    return conditions.summary(condition_keys(spark, d))


@query
def condition_usage(spark, d):
    return conditions.usage(condition_keys(spark, d))


@query
def level1_clusters(spark, d):
    return conditions.level1_clusters(condition_keys(spark, d)).withColumn("rxn_vids", joined("rxn_vids", ","))


@query
def level1_members(spark, d):
    return conditions.level1_members(condition_keys(spark, d))


# Phase 2.


@query
def multiset_delta(spark, d):
    rx = reactions(spark, d)
    chars = rx.select("rxn_vid", p.characters(F.col("reactants_canonical")).alias("a"), p.characters(F.col("products_canonical")).alias("b"))
    return chars.select("rxn_vid", joined(p.multiset_delta(F.col("a"), F.col("b"))).alias("events"))


@query
def mechanism_signatures(spark, d):
    wanted = ("mech_sig_base", "mech_sig_r1", "mech_sig_r2", "signature_type")
    return sigs(spark, d).select(
        "rxn_vid",
        "cluster_id",
        *wanted,
        joined("event_tokens").alias("event_tokens"),
        F.col("redox_events").cast("long"),
        F.col("ring_events").cast("long"),
        "scaffold_key",
        "coarse_key_hash",
    )


@query
def unmapped_signatures(spark, d):
    """Part names backwards have the same characters, so that no reaction is mapped."""
    part = spark.read.parquet(f"{d}/part.parquet")
    word = F.split_part("p_name", F.lit(" "), F.lit(1))
    rows = part.select(
        F.col("p_partkey").alias("rxn_vid"), F.col("p_brand").alias("cond_hash"), F.array(word).alias("reactants_canonical"),
        F.array(F.reverse(word)).alias("products_canonical"), word.alias("role_main_substrate"),
    )
    found = mechanism.signatures(rows.select("rxn_vid", "cond_hash"), rows)
    return found.select("rxn_vid", "signature_type", "mech_sig_base", joined("event_tokens").alias("event_tokens"), "scaffold_key")


@query
def level2_members(spark, d):
    return mechanism.level2_members(sigs(spark, d))


@query
def coarse_keys(spark, d):
    return mechanism.coarse_usage(sigs(spark, d))


@query
def level2_clusters(spark, d):
    return clusters2(spark, d).select(
        "cond_hash",
        "cluster_id",
        "mech_sig_base",
        "coarse_text",
        "rxn_count",
        F.size("mech_sig_base_counts").cast("long").alias("n_bases"),
        joined("rxn_vids", ",").alias("rxn_vids"),
    )


@query
def mechanism_summary(spark, d):
    return mechanism.summary(sigs(spark, d))


@query
def mechanism_percentiles(spark, d):
    return rounded(mechanism.percentiles(clusters2(spark, d), "rxn_count"))


@query
def mechanism_usage(spark, d):
    s = sigs(spark, d)
    return mechanism.usage(s, mechanism.level2_clusters(s))


@query
def mechanism_spread(spark, d):
    s = sigs(spark, d)
    return mechanism.spread(s, mechanism.level2_clusters(s))


@query
def single_condition_keys(spark, d):
    return mechanism.single_condition_keys(sigs(spark, d))


@query
def largest_clusters(spark, d):
    return mechanism.largest_clusters(clusters2(spark, d))


@query
def family_sizes(spark, d):
    return mechanism.family_sizes(clusters2(spark, d))


@query
def event_family_sizes(spark, d):
    return mechanism.event_family_sizes(clusters2(spark, d))


# Phase 3.


@query
def fingerprint_bits(spark, d):
    return feats(spark, d).select("rxn_vid", "CID", "MID", "scaffold_key", joined("fingerprint_bits", ",").alias("fingerprint_bits"))


@query
def canopy_clusters(spark, d):
    return structures.assign_structures(feats(spark, d)).select("rxn_vid", "SID")


@query
def level3_clusters(spark, d):
    made = structures.level3_clusters(structures.assign_structures(feats(spark, d)))
    return made.withColumns({c: joined(c, ",") for c in ("rxn_vids", "exemplar_vids")})


@query
def ann_manifest(spark, d):
    return structures.ann_manifest(feats(spark, d))


@query
def ann_stand_in(spark, d):
    return structures.stand_in_search(feats(spark, d))


@query
def ann_search(spark, d):
    return rounded(canopy.search(feats(spark, d), F.col("rxn_vid") % 100 == 0))


@query
def level3_members(spark, d):
    return structures.level3_members(structures.assign_structures(feats(spark, d)))


@query
def silent_structures(spark, d):
    """Reactions without events, all alike: every warning of phase 3 but that of empty fingerprints."""
    region = spark.read.parquet(f"{d}/region.parquet")
    same = {"CID": "c", "MID": "m", "scaffold_key": "S", "mech_sig_base": "b"}
    rows = region.select(F.col("r_regionkey").alias("rxn_vid"), *[F.lit(v).alias(k) for k, v in same.items()], p.no_texts().alias("event_tokens"))
    return structures.warnings(structures.features(rows))


@query
def structure_summary(spark, d):
    return structures.summary(feats(spark, d))


@query
def structure_usage(spark, d):
    return structures.usage(feats(spark, d))


@query
def structure_spread(spark, d):
    return structures.spread(feats(spark, d))


@query
def structure_warnings(spark, d):
    return structures.warnings(feats(spark, d))


@query
def sampled_similarity(spark, d):
    return structures.sampled_similarity(feats(spark, d))


# Phase 4.


@query
def merge_assignments(spark, d):
    return fused(spark, d, check=True)[0]


@query
def cluster_cards(spark, d):
    cards = fused(spark, d)[1].withColumn("exemplars", joined("exemplars", ","))
    return rounded(cards.withColumns({c: written(c) for c in ("top_solvents", "top_temperatures", "mechanism_summary")}))


@query
def clusters_final(spark, d):
    final = fusion.clusters_final(*fused(spark, d))
    values = "array<struct<value:string,count:long>>"
    lists = ("top_solvents", "top_temperatures", "mechanism_summary")
    kinds = "CID string, MID string, size long, dominant_scaffold string, exemplars array<string>, yield_count long"
    read = final.withColumn("card", F.from_json("cluster_card", ", ".join([kinds, *[f"{c} {values}" for c in lists]])))
    return read.select(
        "rxn_vid", "SID", F.col("card.size").alias("card_size"), "card.dominant_scaffold", "card.CID", "card.MID", "card.yield_count",
        joined("card.exemplars", ",").alias("exemplars"), *[written(f"card.{c}").alias(c) for c in lists],
    )


def shared_views(spark, d):
    """Brands, kinds and sizes of the parts of order lines as conditions and clusters that conditions share."""
    line, part = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("lineitem", "part"))
    both = line.join(part, line["l_partkey"] == part["p_partkey"])
    return both.select(
        "l_orderkey", "l_linenumber", F.col("p_brand").alias("CID"), F.split_part("p_type", F.lit(" "), F.lit(1)).alias("MID"),
        F.concat(F.lit("S"), F.col("p_size") % 5).alias("SID"),
    ).distinct()


@query
def cross_view_edges(spark, d):
    return fusion.cross_view_edges(shared_views(spark, d))


@query
def cross_view_classes(spark, d):
    return fusion.cross_view_classes(shared_views(spark, d))


@query
def edge_lines(spark, d):
    """The edges as JSON lines, read back."""
    lines = files.json_lines(fusion.cross_view_edges(shared_views(spark, d)))
    return lines.select(F.from_json("value", "kind string, shared_id string, source string, target string, weight long").alias("x")).select("x.*")


@query
def stats_jsonl(spark, d):
    merged, cards = fused(spark, d)
    lines = files.json_lines(fusion.stats_lines(cards, fusion.cross_view_edges(merged)))
    return lines.groupBy(F.get_json_object("value", "$.type").alias("type")).agg(F.count("*").alias("n"))


@query
def top_values(spark, d):
    found = fusion.top_values(spark.read.parquet(f"{d}/orders.parquet"), ["o_orderstatus"], "o_orderpriority")
    return found.withColumn("top", written("top"))


@query
def yield_summary(spark, d):
    return rounded(fusion.yield_summary(spark.read.parquet(f"{d}/customer.parquet"), ["c_mktsegment"], "c_acctbal"), 4)


# Coherence report.


@query
def cluster_metrics(spark, d):
    return rounded(metrics(spark, d).drop("coarse_families"))


@query
def signature_metrics(spark, d):
    return rounded(coherence.signature_metrics(sigs(spark, d)))


def enriched(spark, d):
    s = sigs(spark, d)
    return coherence.enrich(coherence.cluster_metrics(mechanism.level2_clusters(s)), coherence.signature_metrics(s))


@query
def cluster_enriched(spark, d):
    return rounded(enriched(spark, d).select("cluster_id", "rxn_count", "event_entropy", "mapped_share"))


@query
def size_histogram(spark, d):
    return coherence.size_histogram(metrics(spark, d))


@query
def cumulative_coverage(spark, d):
    return rounded(coherence.cumulative_coverage(metrics(spark, d)), 9)


@query
def size_entropy_points(spark, d):
    return rounded(coherence.scatter(metrics(spark, d), "rxn_count", "base_entropy")).groupBy("x", "y").agg(F.count("*").alias("n"))


@query
def size_top1_points(spark, d):
    return rounded(coherence.scatter(metrics(spark, d), "rxn_count", "top1_base_share")).groupBy("x", "y").agg(F.count("*").alias("n"))


@query
def entropy_correlation(spark, d):
    return rounded(coherence.correlation(metrics(spark, d), "rxn_count", "base_entropy"))


@query
def event_entropy_correlation(spark, d):
    return rounded(coherence.correlation(enriched(spark, d), "base_entropy", "event_entropy"))


@query
def entropy_pair_points(spark, d):
    return rounded(coherence.scatter(enriched(spark, d), "base_entropy", "event_entropy")).groupBy("x", "y").agg(F.count("*").alias("n"))


@query
def entropy_by_scaffold(spark, d):
    found = coherence.entropy_by_scaffold(metrics(spark, d))
    return found.withColumn("q", joined(F.transform("q", lambda x: F.round(x * 1000).cast("long")), ","))


@query
def mapped_share_histogram(spark, d):
    return coherence.mapped_share_histogram(enriched(spark, d))


@query
def coherence_overview(spark, d):
    return coherence.overview(metrics(spark, d))


def queries() -> dict[str, Query]:
    return dict(REGISTERED)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in REGISTERED}


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalize, deduplicate, key and count: the ten largest conditions."""
    groups = condition_groups(spark, sf_dir)
    return groups.orderBy(F.desc("n"), "cond_hash").limit(10)
