"""The phases as jobs: tables in, tables out.

Each job reads files, writes the phase's tables with Spark's _SUCCESS markers,
and returns its reports, small tables by name. Run them with ``python -m
alembiq``. With ``sample`` a job takes 1,000 rows of each input: the least keys
where there is one, else the first ones. Where the first or last of equal rows
counts, the order is that of the input's files by name.

Tables with one row a reaction are written in ``buckets`` by ``rxn_vid``, so
that the next phase joins them without an exchange; 0 takes the session's
shuffle partitions. Members of clusters go from phase to phase as rows.
``arrays`` adds the lists of members to the tables of clusters: for tools that
expect them, where the members of every cluster fit a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .operators import canopy, coherence, conditions, fusion, mechanism, normalize, structures
from .shared import cut
from .sources import files

Reports = dict[str, DataFrame]


def _read(spark: SparkSession, path: str, sample: bool, key: str = "rxn_vid") -> DataFrame:
    df = files.read_table(spark, path)
    if not sample:
        return df
    return files.sample(df, key) if key in df.columns else df.limit(1000)


def phase0(
    spark: SparkSession, input: str, output: str, failed_output: str | None = None, sample: bool = False, hash_mode: str = "sha2", interchange: bool = False,
    buckets: int = 0,
) -> Reports:
    """Raw reactions to normalized ones; failures to a table of their own, written only if there are any.

    With ``interchange`` nested columns are written as JSON text.
    """
    with files.case_sensitive(spark):
        raw = files.read_ordered(spark, input, "_ord")
        table = normalize.normalized_table(raw.orderBy("_ord").limit(1000) if sample else raw, hash_mode, "_ord")
    good, bad = normalize.split_failures(table)
    done = normalize.number(normalize.deduplicate(good), "reaction_hash_v1", "rxn_vid")
    if interchange:
        done = cut(done, "numbered")
    files.write_keyed(files.interchange(done) if interchange else done, output, "rxn_vid", buckets)
    if failed_output:
        files.write_failures(bad, failed_output)
    kept = done if interchange else spark.read.parquet(output)
    return {
        "summary": normalize.summary(table),
        "failures": normalize.failure_counts(table),
        "warnings": normalize.warnings(table),
        "usage": normalize.usage(good, kept),
        "spread": normalize.spread(good),
    }


def phase1(
    spark: SparkSession, input: str, output: str, clusters: str | None = None, sample: bool = False, hash_mode: str = "sha2", buckets: int = 0,
    arrays: bool = False,
) -> Reports:
    """Condition keys of normalized reactions, and the level-1 members (with ``arrays``: clusters) if a path is given."""
    files.write_keyed(conditions.condition_keys(_read(spark, input, sample), hash_mode), output, "rxn_vid", buckets)
    keys = files.read_table(spark, output)
    if clusters and arrays:
        files.write_table(conditions.level1_clusters(keys), clusters)
    elif clusters:
        files.write_keyed(conditions.level1_members(keys), clusters, "rxn_vid", buckets)
    return {"summary": conditions.summary(keys), "usage": conditions.usage(keys)}


def phase2(
    spark: SparkSession, input: str, cond_table: str, output_dir: str, sample: bool = False, hash_mode: str = "sha2", buckets: int = 0, arrays: bool = False
) -> Reports:
    """Signatures, level-2 members and clusters."""
    sigs = mechanism.signatures(_read(spark, cond_table, sample), _read(spark, input, sample), hash_mode)
    files.write_keyed(mechanism.assign_clusters(sigs), f"{output_dir}/mechanism_sigs.parquet", "rxn_vid", buckets)
    sigs = files.read_table(spark, f"{output_dir}/mechanism_sigs.parquet")
    files.write_keyed(mechanism.level2_members(sigs), f"{output_dir}/members_level2.parquet", "rxn_vid", buckets)
    files.write_table(mechanism.level2_clusters(sigs, arrays), f"{output_dir}/clusters_level2.parquet", order=("cond_hash", "cluster_id"))
    clusters = spark.read.parquet(f"{output_dir}/clusters_level2.parquet")
    return {
        "summary": mechanism.summary(sigs),
        "usage": mechanism.usage(sigs, clusters),
        "spread": mechanism.spread(sigs, clusters),
        "single_condition_keys": mechanism.single_condition_keys(sigs),
        "largest_clusters": mechanism.largest_clusters(clusters),
        "family_sizes": mechanism.family_sizes(clusters),
    }


def phase3(
    spark: SparkSession, mechanism_sigs: str, clusters_level2: str, output_dir: str, sample: bool = False, fp_bits: int = 128, canopy_threshold: float = 0.6,
    hash_mode: str = "sha2", buckets: int = 0, arrays: bool = False,
) -> Reports:
    """Fingerprints, level-3 members and clusters, the index of fingerprints (``canopy.search`` asks it) and its manifest.

    ``clusters_level2`` is the table of members, or one of clusters with lists.
    """
    joined = structures.join_levels(structures.expand(files.read_table(spark, clusters_level2)), files.read_table(spark, mechanism_sigs))
    if sample:
        joined = files.sample(joined, "rxn_vid")
    assigned = structures.assign_structures(structures.features(joined, fp_bits, hash_mode), canopy_threshold)
    files.write_keyed(structures.vectors(assigned), f"{output_dir}/structure_feats.parquet", "rxn_vid", buckets)
    feats = files.read_table(spark, f"{output_dir}/structure_feats.parquet")
    files.write_keyed(structures.level3_members(feats), f"{output_dir}/members_level3.parquet", "rxn_vid", buckets)
    files.write_table(structures.level3_clusters(feats, arrays), f"{output_dir}/clusters_level3.parquet", order=("CID", "MID", "SID"))
    files.write_jsonl(structures.ann_manifest(feats), f"{output_dir}/indices")
    files.write_table(canopy.build_index(feats, canopy_threshold), f"{output_dir}/index.parquet")
    return {
        "summary": structures.summary(feats),
        "usage": structures.usage(feats),
        "spread": structures.spread(feats),
        "similarity": structures.sampled_similarity(feats),
        "warnings": structures.warnings(feats),
    }


def phase4(
    spark: SparkSession, clusters_level1: str, clusters_level2: str, clusters_level3: str, mechanism_sigs: str, structure_feats: str, reactions: str,
    output_dir: str, sample: bool = False, buckets: int = 0,
) -> Reports:
    """Assignments, also with their cards, and the cards and edges as JSON lines. Levels are tables of members, or of clusters with lists."""
    levels = (files.read_ordered(spark, p) for p in (clusters_level1, clusters_level2, clusters_level3))
    first = lambda x: files.sample(x, "rxn_vid" if "rxn_vid" in x.columns else "ord")
    level1, level2, level3 = (first(x) if sample else x for x in levels)
    sigs, feats = (_read(spark, p, sample) for p in (mechanism_sigs, structure_feats))
    rx = files.sample(files.read_ordered(spark, reactions), "rxn_vid") if sample else files.read_ordered(spark, reactions)
    if "MID" not in level2.columns:
        level2 = level2.withColumnsRenamed({"cond_hash": "CID", "cluster_id": "MID"})
    files.write_keyed(fusion.merge_assignments(level1, level2, level3), f"{output_dir}/assignments.parquet", "rxn_vid", buckets)
    merged = files.read_table(spark, f"{output_dir}/assignments.parquet")
    cards = cut(fusion.cluster_cards(merged, feats, sigs, rx), "cards")
    edges = fusion.cross_view_edges(merged)
    files.write_table(fusion.clusters_final(merged, cards), f"{output_dir}/clusters_final.parquet", order=("rxn_vid",))
    lines = fusion.stats_lines(cards, edges).orderBy("type", *fusion.KEY, "kind", "shared_id", "source", "target")
    files.write_jsonl(lines, f"{output_dir}/cluster_stats.jsonl")
    return {"largest": cards.select(*fusion.KEY, "size").orderBy("size", ascending=False).limit(5)}


def report(spark: SparkSession, clusters: str, outdir: str, signatures: str | None = None) -> Reports:
    """The table behind each figure of the coherence report."""
    metrics = coherence.cluster_metrics(files.read_table(spark, clusters))
    by_signature = coherence.signature_metrics(files.read_table(spark, signatures)) if signatures else None
    files.write_table(coherence.enrich(metrics, by_signature), f"{outdir}/clusters.parquet")
    table = spark.read.parquet(f"{outdir}/clusters.parquet")
    made = {
        "size_histogram": coherence.size_histogram(table),
        "cumulative_coverage": coherence.cumulative_coverage(table),
        "size_entropy": coherence.scatter(table, "rxn_count", "base_entropy"),
        "size_top1": coherence.scatter(table, "rxn_count", "top1_base_share"),
        "entropy_by_scaffold": coherence.entropy_by_scaffold(table),
    }
    if by_signature is not None:
        made["entropy_event_entropy"] = coherence.scatter(table, "base_entropy", "event_entropy")
        made["mapped_share_histogram"] = coherence.mapped_share_histogram(table)
    for name, df in made.items():
        files.write_table(df, f"{outdir}/{name}.parquet")
    return {
        "overview": coherence.overview(table),
        "size_entropy": coherence.correlation(table, "rxn_count", "base_entropy"),
        "entropy_event_entropy": coherence.correlation(table, "base_entropy", "event_entropy"),
    }
