"""Coherence of level-2 clusters: the table behind each figure of the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chemistry as chem
from ..functions import parsing as p
from ..shared import cut
from .quantiles import quantiles


def entropy(counts: Column) -> Column:
    """Shannon entropy in bits of an array of counts; 0 without positive ones."""
    good = F.filter(counts, lambda x: x > 0)
    total = F.aggregate(good, F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, F.aggregate(good, F.lit(0.0), lambda a, x: a - x / total * F.log2(x / total))).otherwise(0.0)


def top_share(counts: Column) -> Column:
    """Share of the largest of an array of counts; 0 without positive ones."""
    good = F.filter(counts, lambda x: x > 0)
    total = F.aggregate(good, F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, F.array_max(good) / total).otherwise(0.0)


def cluster_metrics(clusters: DataFrame) -> DataFrame:
    """Level-2 clusters with diversity, entropy and top share of their base signatures.

    Counts and coarse keys may be JSON text, as in interchange files.
    """
    kinds = dict(clusters.dtypes)
    if "cluster_id" not in kinds:
        raise ValueError("clusters need cluster_id")
    if kinds.get("mech_sig_base_counts") == "string":
        counts = F.coalesce(p.json_counts(F.col("mech_sig_base_counts")), F.create_map().cast("map<string,bigint>"))
        clusters = clusters.withColumn("mech_sig_base_counts", counts)
    if kinds.get("coarse_key") == "string":
        clusters = clusters.withColumn("coarse_key", p.coarse_key(F.col("coarse_key")))
    n = F.map_values("mech_sig_base_counts")
    count = F.col("rxn_count") if "rxn_count" in clusters.columns else F.aggregate(n, F.lit(0).cast("long"), lambda a, x: a + x)
    return clusters.select(
        "cluster_id",
        count.alias("rxn_count"),
        F.size(n).alias("base_diversity"),
        entropy(n).alias("base_entropy"),
        top_share(n).alias("top1_base_share"),
        F.col("coarse_key.scaffold").alias("coarse_scaffold"),
        F.col("coarse_key.families").alias("coarse_families"),
    )


def counted_metrics(counted: DataFrame, cluster: list[str], n: str = "n") -> DataFrame:
    """The same numbers from one row with count ``n`` for each base of a cluster: rxn_count, base_diversity, base_entropy, top1_base_share.

    The entropy follows from the sum of n log n, so that no cluster's bases
    meet in one row. Entropy and share are rounded to six places.
    """
    total = F.sum(n)
    spread = F.log2(total) - F.sum(F.col(n) * F.log2(n)) / total
    return counted.groupBy(*cluster).agg(
        total.alias("rxn_count"),
        F.count("*").alias("base_diversity"),
        F.abs(F.round(spread, 6)).alias("base_entropy"),
        F.round(F.max(n) / total, 6).alias("top1_base_share"),
    )


def signature_metrics(sigs: DataFrame) -> DataFrame | None:
    """Per cluster: entropy of event families, mean tokens, share of mapped rows; None without cluster_id.

    Families are found for the distinct tokens and joined to their counts.
    """
    kinds = dict(sigs.dtypes)
    if "cluster_id" not in kinds:
        return None
    if kinds["event_tokens"] == "string":  # JSON text, as in interchange files
        sigs = sigs.withColumn("event_tokens", p.to_list(F.col("event_tokens")))
    rows = sigs.filter("cluster_id is not null")
    mapped = F.coalesce(F.lower("signature_type") == "mapped", F.lit(False)) if "signature_type" in sigs.columns else F.lit(False)
    base = rows.groupBy("cluster_id").agg(F.avg(F.size("event_tokens")).alias("event_token_mean"), F.avg(mapped.cast("int")).alias("mapped_share"))
    each = rows.select("cluster_id", F.explode("event_tokens").alias("t")).groupBy("cluster_id", "t").agg(F.count("*").alias("n"))
    tokens = cut(rows.select(F.explode("event_tokens").alias("token")).distinct(), "tokens")
    named = cut(tokens.select("token", chem.event_family(F.col("token"), composite=False).alias("family")), "families")
    families = each.join(named, F.col("t").eqNullSafe(F.col("token"))).groupBy("cluster_id", "family").agg(F.sum("n").alias("n"))
    counted = families.groupBy("cluster_id").agg(F.collect_list("n").alias("ns"))
    spread = counted.select("cluster_id", entropy(F.array_sort("ns")).alias("event_entropy"))
    return base.join(spread, "cluster_id", "left").withColumn("event_entropy", F.coalesce("event_entropy", F.lit(0.0)))


def enrich(metrics: DataFrame, by_signature: DataFrame | None) -> DataFrame:
    """Left join, or null columns."""
    names = ("event_entropy", "event_token_mean", "mapped_share")
    if by_signature is None:
        return metrics.withColumns({c: F.lit(None).cast("double") for c in names})
    return metrics.join(by_signature.select("cluster_id", *names), "cluster_id", "left")


def size_histogram(metrics: DataFrame) -> DataFrame:
    """(bin, low, high, n) with the Freedman-Diaconis number of bins, 5 to 80, 30 where the spread is zero."""
    metrics = cut(metrics.select("rxn_count"), "sizes")
    found = quantiles(metrics, [], "rxn_count", (0.25, 0.75)).select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    stats = metrics.agg(F.count("*").alias("n"), F.min("rxn_count").alias("low"), F.max("rxn_count").alias("high")).join(F.broadcast(found))
    width = 2 * (F.col("q3") - F.col("q1")) / F.pow("n", F.lit(1 / 3))
    bins = F.when(width > 0, F.greatest(F.lit(5), F.least(F.lit(80), F.floor((F.col("high") - F.col("low")) / width)))).otherwise(30)
    stats = stats.withColumn("bins", bins.cast("long"))
    step = (F.col("high") - F.col("low")) / F.col("bins")
    place = F.when(step > 0, F.least(F.floor((F.col("rxn_count") - F.col("low")) / step), F.col("bins") - 1)).otherwise(0)
    placed = metrics.select("rxn_count").join(F.broadcast(stats)).select("low", step.alias("step"), place.cast("long").alias("bin"))
    return placed.groupBy("bin").agg(
        F.round(F.first("low") + F.col("bin") * F.first("step"), 6).alias("low"),
        F.round(F.first("low") + (F.col("bin") + 1) * F.first("step"), 6).alias("high"),
        F.count("*").alias("n"),
    )


def cumulative_coverage(metrics: DataFrame) -> DataFrame:
    """(x, y): share of clusters, largest first, and share of reactions they cover.

    Sizes are counted first; the running sums go over the distinct sizes, and
    the clusters of one size are spread again by arithmetic.
    """
    sizes = metrics.groupBy("rxn_count").agg(F.count("*").alias("n"))
    order = Window.orderBy(F.desc("rxn_count")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    run = sizes.select(
        "rxn_count",
        "n",
        F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"),
        F.coalesce(F.sum(F.col("n") * F.col("rxn_count")).over(order), F.lit(0)).alias("covered"),
        F.sum("n").over(every).alias("clusters"),
        F.sum(F.col("n") * F.col("rxn_count")).over(every).alias("reactions"),
    )
    each = run.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("i"))
    return each.select(
        ((F.col("before") + F.col("i")) / F.col("clusters")).alias("x"),
        ((F.col("covered") + F.col("i") * F.col("rxn_count")) / F.greatest(F.col("reactions"), F.lit(1))).alias("y"),
    )


def scatter(metrics: DataFrame, x: str, y: str) -> DataFrame:
    """Points of the rows where both are known."""
    return metrics.select(F.col(x).alias("x"), F.col(y).alias("y")).dropna()


def correlation(metrics: DataFrame, x: str, y: str) -> DataFrame:
    """(n, r): Pearson's r over complete rows, null for two rows or fewer."""
    return scatter(metrics, x, y).agg(F.count("*").alias("n"), F.when(F.count("*") > 2, F.corr("x", "y")).alias("r"))


def entropy_by_scaffold(metrics: DataFrame) -> DataFrame:
    """Five-number summary of base entropy by scaffold family; no rows for fewer than two families."""
    rows = metrics.withColumn("coarse_scaffold", F.coalesce("coarse_scaffold", F.lit("unknown")))
    by = quantiles(rows, ["coarse_scaffold"], "base_entropy", (0.0, 0.25, 0.5, 0.75, 1.0))
    number = by.agg(F.count("*").alias("families"))
    return by.join(F.broadcast(number)).filter("families > 1").select("coarse_scaffold", "q", "n")


def mapped_share_histogram(metrics: DataFrame, bins: int = 20) -> DataFrame:
    """(bin, n) of mapped_share over equal bins of [0, 1], the last one closed."""
    at = F.least(F.width_bucket("mapped_share", F.lit(0.0), F.lit(1.0), F.lit(bins)), F.lit(bins))
    return metrics.filter("mapped_share is not null").groupBy(at.cast("long").alias("bin")).agg(F.count("*").alias("n"))


def overview(metrics: DataFrame) -> DataFrame:
    """The report's headline numbers."""
    three = ("rxn_count", "base_entropy", "top1_base_share")
    metrics = cut(metrics.select(*three), "metrics")
    stacked = metrics.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in three])).alias("x")).select("x.*")
    found = quantiles(stacked, ["name"], "v", (0.5, 0.9))
    at = lambda c, i: F.max(F.when(F.col("name") == c, F.col("q")[i]))
    middle = found.agg(
        at("rxn_count", 0).alias("median_size"),
        at("rxn_count", 1).alias("p90_size"),
        F.round(at("base_entropy", 0), 6).alias("median_entropy"),
        F.round(at("top1_base_share", 0), 6).alias("median_top1"),
    )
    ends = metrics.agg(F.count("*").alias("n_clusters"), F.sum("rxn_count").alias("n_reactions"), F.min("rxn_count").alias("min_size"), F.max("rxn_count").alias("max_size"))
    both = ends.join(F.broadcast(middle))  # one row each
    return both.select("n_clusters", "n_reactions", "min_size", "median_size", "p90_size", "max_size", "median_entropy", "median_top1")
