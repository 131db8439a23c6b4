"""Fusion of the three levels: assignments, cards, edges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parsing as p
from ..functions import units
from ..shared import cut
from .quantiles import quantiles

KEY = ["CID", "MID", "SID"]


def members(level: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(rxn_vid, o, KEY) of a level, as clusters or as members: o is ``ord`` or the scan's order, ids other than ``columns`` are null."""
    have = set(level.columns)
    order = F.col("ord") if "ord" in have else F.monotonically_increasing_id()
    null = F.lit(None).cast("string")
    ids = [p.blank_to_null(F.col(c).cast("string")).alias(c) if c in have and c in columns else null.alias(c) for c in KEY]
    if "rxn_vids" not in have:
        return level.select(F.col("rxn_vid").cast("long").alias("rxn_vid"), order.alias("o"), *ids)
    vids = F.col("rxn_vids") if dict(level.dtypes)["rxn_vids"].startswith("array") else p.lenient_ids(F.col("rxn_vids"))
    each = level.select(order.alias("o"), *ids, vids.alias("vids"))
    return each.select(F.explode(F.col("vids").cast("array<bigint>")).alias("rxn_vid"), "o", *KEY)


def merge_assignments(level1: DataFrame, level2: DataFrame, level3: DataFrame, check: bool = True) -> DataFrame:
    """rxn_vid, CID, MID, SID; finer levels win. Reactions that lack an id are an error that names the first ten.

    Of a level's rows that name a reaction the last one counts. The levels are
    stacked and meet in one aggregation, which member tables in equal buckets
    enter without an exchange. Rows without a reaction are one reaction, null.
    """
    found = [members(x, tuple(KEY[: k + 1])).withColumn("level", F.lit(k)) for k, x in enumerate((level1, level2, level3))]
    last = [F.max_by(F.struct(*KEY), F.when(F.col("level") == k, F.col("o"))).alias(f"l{k + 1}") for k in range(3)]
    merged = reduce(DataFrame.unionByName, found).groupBy("rxn_vid").agg(*last)
    out = merged.select(
        "rxn_vid", F.coalesce("l3.CID", "l2.CID", "l1.CID").alias("CID"), F.coalesce("l3.MID", "l2.MID").alias("MID"), F.col("l3.SID").alias("SID")
    )
    if check:
        gaps = out.filter("CID is null or MID is null or SID is null")
        if first := [r["rxn_vid"] for r in gaps.orderBy("rxn_vid").limit(10).collect()]:
            raise ValueError(f"{gaps.count()} reactions lack cluster ids, the first: {first}")
    return out


def top_values(df: DataFrame, group: list[str], value: str, limit: int = 3, name: str = "top") -> DataFrame:
    """group and an array of (value, count), commonest first, ties by value; null and empty values don't count."""
    counted = df.filter(F.col(value).isNotNull() & (F.col(value).cast("string") != "")).groupBy(*group, value).agg(F.count("*").alias("count"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("count"), F.col(value)))
    best = counted.withColumn("place", place).filter(F.col("place") <= limit)
    listed = F.array_sort(F.collect_list(F.struct("place", F.col(value).cast("string").alias("value"), "count")))
    return best.groupBy(*group).agg(F.transform(listed, lambda x: F.struct(x["value"].alias("value"), x["count"].alias("count"))).alias(name))


def yield_summary(df: DataFrame, group: list[str], value: str = "yield") -> DataFrame:
    """Mean, exact median and count of the numeric values of each group."""
    v = units.plain_number(F.col(value)).alias("_y")
    rows = df.select(*[F.col(c) for c in group], v)
    found = rows.groupBy(*group).agg(F.avg("_y").alias("yield_mean"), F.count("_y").alias("yield_count"))
    middle = quantiles(rows, group, "_y", (0.5,)).select(*group, F.col("q")[0].alias("yield_median"))
    return found.join(middle, group, "left").select(*group, "yield_mean", "yield_median", "yield_count")


def exemplar_names(vids: Column, limit: int = 5) -> Column:
    return F.transform(F.slice(F.array_sort(F.array_distinct(vids)), 1, limit), lambda v: F.concat(F.lit("rxn_"), v.cast("string"), F.lit(".svg")))


def cluster_cards(
    assigned: DataFrame, structures: DataFrame, mechanisms: DataFrame, reactions: DataFrame, top_k: int = 3, exemplar_limit: int = 5
) -> DataFrame:
    """One card per (CID, MID, SID).

    Each source gives its values as (kind, value) items of a reaction; they are
    stacked, meet the assignments in one join, and all are counted in one
    aggregation. A reaction that a source has twice counts twice there and
    nowhere else.
    """
    order = F.col("ord") if "ord" in reactions.columns else F.monotonically_increasing_id()
    wanted = ["solvent_normalized", "temperature_K", "yield"]
    last = reactions.withColumn("_o", order).groupBy("rxn_vid").agg(F.max_by(F.struct(*wanted), "_o").alias("r")).select("rxn_vid", "r.*")
    item = lambda kind, v: F.struct(F.lit(kind).alias("kind"), v.cast("string").alias("value"))
    none = F.lit(None).cast("double")
    tokens = F.concat("event_tokens", F.array("mech_sig_base"))
    reaction = [item("solvent", F.get("solvent_normalized", F.lit(0))), item("temperature", units.temperature_label(F.col("temperature_K")))]
    sources = [
        structures.select("rxn_vid", F.array(item("scaffold", F.col("scaffold_key"))).alias("items"), none.alias("y")),
        mechanisms.select("rxn_vid", F.transform(tokens, lambda t: item("token", t)).alias("items"), none.alias("y")),
        last.select("rxn_vid", F.array(*reaction).alias("items"), units.plain_number(F.col("yield")).alias("y")),
    ]
    facts = cut(assigned.select("rxn_vid", *KEY).join(reduce(DataFrame.unionByName, sources), "rxn_vid").drop("rxn_vid"), "facts")
    each = facts.select(*KEY, F.explode("items").alias("x")).filter("x.value <> ''")
    counted = each.groupBy(*KEY, "x.kind", "x.value").agg(F.count("*").alias("count"))
    most = {"scaffold": 1, "solvent": top_k, "temperature": top_k, "token": max(top_k, 5)}
    limit = reduce(lambda c, kind: c.when(F.col("kind") == kind, most[kind]), most, F.when(F.lit(False), 0))
    place = F.row_number().over(Window.partitionBy(*KEY, "kind").orderBy(F.desc("count"), "value"))
    best = counted.withColumn("place", place).filter(F.col("place") <= limit)

    def listed(kind: str) -> Column:
        found = F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("place", "value", "count"))))
        return F.transform(found, lambda x: F.struct(x["value"].alias("value"), x["count"].alias("count")))

    tops = best.groupBy(*KEY).agg(
        F.max(F.when(F.col("kind") == "scaffold", F.col("value"))).alias("dominant_scaffold"),
        listed("solvent").alias("top_solvents"),
        listed("temperature").alias("top_temperatures"),
        listed("token").alias("mechanism_summary"),
    )
    # members are distinct, so that the first of a window are the exemplars; no cluster is collected
    nth = F.row_number().over(Window.partitionBy(*KEY).orderBy("rxn_vid"))
    first = assigned.select(*KEY, "rxn_vid").withColumn("nth", nth).filter(F.col("nth") <= exemplar_limit)
    exemplars = first.groupBy(*KEY).agg(exemplar_names(F.collect_list("rxn_vid"), exemplar_limit).alias("exemplars"))
    size = assigned.groupBy(*KEY).agg(F.count("*").alias("size"))
    parts = [exemplars, tops, yield_summary(facts.filter("y is not null"), KEY, "y")]
    cards = reduce(lambda a, b: a.join(b, KEY, "left"), parts, size)
    empty = F.array().cast("array<struct<value:string,count:bigint>>")
    filled = {c: F.coalesce(c, empty) for c in ("top_solvents", "top_temperatures", "mechanism_summary")}
    return cards.withColumns(filled | {"yield_count": F.coalesce("yield_count", F.lit(0).cast("long"))})


def cross_view_classes(assigned: DataFrame) -> DataFrame:
    """kind, shared_id, conditions, reactions, largest: each MID and SID that several conditions share, as one row.

    The pairs of ``cross_view_edges`` are those of its conditions; this form
    grows with the ids, not with the pairs.
    """
    by = shared_counts(assigned).groupBy("kind", "shared_id")
    found = by.agg(F.count("*").alias("conditions"), F.sum("n").alias("reactions"), F.max("n").alias("largest"))
    return found.filter("conditions > 1")


def shared_counts(assigned: DataFrame) -> DataFrame:
    """kind, shared_id, CID, n: reactions of every condition under each MID and SID."""
    kinds = F.array(F.struct(F.lit("MID").alias("kind"), F.col("MID").alias("shared_id")), F.struct(F.lit("SID").alias("kind"), F.col("SID").alias("shared_id")))
    return assigned.select("CID", F.explode(kinds).alias("x")).groupBy("x.kind", "x.shared_id", "CID").agg(F.count("*").alias("n"))


#: Conditions of one shared id that a task pairs with as many others.
BLOCK = 512


def pairs_of(counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """kind, shared_id, source, target, weight of ``shared_counts``: every two conditions of an id, weight the smaller count.

    The conditions of an id that has more than ``block`` are dealt to blocks by
    their hash, and two blocks i <= j are one join key: each condition is
    copied once for each block, on the side of the smaller block's number as
    source and on the other as target. So no id's pairs are one task's, and the
    pairs of a key are bounded by the square of a block.
    """
    key = ["kind", "shared_id"]
    sizes = counts.groupBy(*key).agg(F.count("*").alias("m")).filter("m > 1")
    blocks = sizes.select(*key, F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    dealt = counts.join(blocks, key).withColumn("own", F.pmod(F.xxhash64("CID"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    lower = dealt.select(*key, F.col("CID").alias("c1"), F.col("n").alias("n1"), F.col("own").alias("i"), other).filter("i <= other").withColumnRenamed("other", "j")
    upper = dealt.select(*key, F.col("CID").alias("c2"), F.col("n").alias("n2"), F.col("own").alias("j"), other).filter("other <= j").withColumnRenamed("other", "i")
    met = lower.join(upper, [*key, "i", "j"]).filter((F.col("i") < F.col("j")) | (F.col("c1") < F.col("c2")))
    return met.select(*key, F.least("c1", "c2").alias("source"), F.greatest("c1", "c2").alias("target"), F.least("n1", "n2").alias("weight"))


def cross_view_edges(assigned: DataFrame, block: int = BLOCK) -> DataFrame:
    """kind, shared_id, source, target, weight: pairs of conditions that share a MID or SID; weight is the smaller count."""
    return pairs_of(cut(shared_counts(assigned), "shared"), block)


def clusters_final(assigned: DataFrame, cards: DataFrame) -> DataFrame:
    """Assignments with their card as JSON."""
    rest = sorted(c for c in cards.columns if c not in KEY)
    text = cards.select(*KEY, F.to_json(F.struct(*sorted([*rest, *KEY]))).alias("cluster_card"))
    return assigned.join(text, KEY, "left").select("rxn_vid", *KEY, "cluster_card")


def stats_lines(cards: DataFrame, edges: DataFrame) -> DataFrame:
    """Cards and edges as one table of tagged rows, for the JSON-lines sink."""
    return cards.withColumn("type", F.lit("cluster_card")).unionByName(edges.withColumn("type", F.lit("cross_view_edge")), allowMissingColumns=True)
