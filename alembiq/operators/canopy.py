"""Greedy leader clustering and exact nearest neighbours of fingerprints.

Similar fingerprints of large groups meet in ``bands``. Blocks of bounded size
are compared as matrices: the common bits of two sets of fingerprints are one
product of their bit matrices.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import cut
from . import bands

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GROUP = ["CID", "MID"]
#: Distinct fingerprints that one task holds of a group at a time.
BLOCK = 2048
ROWS = "array<struct<pos:bigint,bits:array<int>>>"


def matrix(lists: list, width: int) -> np.ndarray:
    """0/1 rows of lists of bits."""
    out = np.zeros((len(lists), width), dtype=np.float32)
    at = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    out[at, np.fromiter((b for x in lists for b in x), dtype=np.int64, count=len(at))] = 1
    return out


def similarities(a: list, b: list) -> np.ndarray:
    """Tanimoto similarity of every pair; two empty fingerprints are equal."""
    width = 1 + max((x[-1] for x in (*a, *b) if len(x)), default=0)
    left, right = matrix(a, width), matrix(b, width)
    common = (left @ right.T).astype(np.float64)
    union = left.sum(axis=1, dtype=np.float64)[:, None] + right.sum(axis=1, dtype=np.float64)[None, :] - common
    return np.divide(common, union, out=np.ones_like(common), where=union > 0)


def lead(bits: list, threshold: float) -> np.ndarray:
    """For each fingerprint in order the number of the earliest leader it resembles; who resembles none leads."""
    near = similarities(bits, bits) >= threshold
    leader = np.full(len(bits), -1)
    for i in range(len(bits)):
        if leader[i] < 0:
            joins = near[i] & (leader < 0)
            joins[: i + 1] = False
            leader[joins] = i
            leader[i] = i
    return leader


def ranked(df: DataFrame, order: str, name: str) -> DataFrame:
    """Add the 1-based rank by ``order`` within (CID, MID), without a task for each group.

    Rows are range-partitioned; a row's rank is its place in its partition
    among its group, after the group's rows in earlier partitions. Only the
    counts of (group, partition) are summed in order.
    """
    placed = df.repartitionByRange(*GROUP, order).sortWithinPartitions(*GROUP, order)
    fixed = cut(placed.withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33)), "ranked")
    sizes = fixed.groupBy(*GROUP, "_part").agg(F.count("*").alias("n"), F.min("_id").alias("_first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*GROUP).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(*GROUP, "_part", "_first", before.alias("_before"))
    at = F.col("_before") + F.col("_id") - F.col("_first") + 1
    return fixed.join(offsets, [*GROUP, "_part"]).withColumn(name, at).drop("_id", "_part", "_first", "_before")


#: Pairs that meet in bands in one round at most, unless the round is a single block.
MEETINGS = 1 << 26
#: Growth of the rows that a round decides.
GROWTH = 8
NODE = ["gid", "pos"]


def similar(a: DataFrame, b: DataFrame, threshold: float, n_words: int, ordered: bool) -> DataFrame:
    """(gid, a, b): rows of exploded bands a and b of one group that are similar; ``ordered`` keeps those where a comes before b."""
    left = a.select("gid", "pair", "code", F.col("pos").alias("a"), F.col("size").alias("size_a"), F.col("w").alias("w_a"))
    right = b.select("gid", "pair", "code", F.col("pos").alias("b"), F.col("size").alias("size_b"), F.col("w").alias("w_b"))
    met = left.join(right, ["gid", "pair", "code"])
    met = met.filter(F.col("a") < F.col("b")) if ordered else met
    score = bands.tanimoto(F.col("w_a"), F.col("w_b"), F.col("size_a"), F.col("size_b"), n_words)
    return met.filter(score >= threshold).select("gid", "a", "b").distinct()


def first_independent(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The leaders among nodes(gid, pos): those without an edge (gid, a, b), a before b, from a leader.

    By dependency rounds: nodes with no edge from an undecided one lead, those
    they reach don't, and both leave. Edges that are left connect undecided
    nodes; rounds end when there are none.
    """
    leaders = []
    while True:
        lead = cut(nodes.join(edges.select("gid", F.col("b").alias("pos")).distinct(), NODE, "left_anti"), "leading")
        leaders.append(lead)
        if edges.isEmpty():
            return reduce(DataFrame.unionByName, leaders)
        reached = edges.join(lead.withColumnRenamed("pos", "a"), ["gid", "a"], "left_semi").select("gid", F.col("b").alias("pos")).distinct()
        gone = cut(lead.unionByName(reached), "decided")
        nodes = cut(nodes.join(gone, NODE, "left_anti"), "undecided")
        for end in ("a", "b"):
            edges = edges.join(gone.withColumnRenamed("pos", end), ["gid", end], "left_anti")
        edges = cut(edges, "edges")


def _decided(threshold: float):
    """The leader of each row of a block, and the leaders' rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for gid, rows in zip(batch["gid"], batch["rows"], strict=True):
                found = lead([r["bits"] for r in rows], threshold)
                decided = [{"b": r["pos"], "a": rows[k]["pos"]} for r, k in zip(rows, found.tolist(), strict=True)]
                yield pd.DataFrame([(gid, decided, [rows[k] for k in np.unique(found).tolist()])], columns=["gid", "decided", "leaders"])

    return run


def _joined(threshold: float):
    """The earliest of a block's leaders that each row of a pack resembles."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for gid, rows, leaders in zip(batch["gid"], batch["rows"], batch["leaders"], strict=True):
                near = similarities([r["bits"] for r in rows], [x["bits"] for x in leaders]) >= threshold
                first, found = near.argmax(axis=1).tolist(), near.any(axis=1).tolist()
                some = [(gid, r["pos"], leaders[k]["pos"]) for r, f, k in zip(rows, found, first, strict=True) if f]
                yield pd.DataFrame(some, columns=["gid", "b", "a"])

    return run


#: Tasks that the packs of one group are dealt to.
SALTS = 64


def by_block(rows: DataFrame, now: DataFrame, later: DataFrame, threshold: float, block: int) -> DataFrame:
    """(gid, b, a): rows(gid, pos, fingerprint_bits) that follow from the first ``block`` of each group, with their leaders, by matrices.

    ``now`` are the block's rows, decided in one task for each group; ``later``
    ones meet the block's leaders in packs.
    """
    held = F.struct("pos", F.col("fingerprint_bits").alias("bits"))
    first = rows.join(now, NODE, "left_semi").groupBy("gid").agg(F.array_sort(F.collect_list(held)).alias("rows"))
    found = cut(first.mapInPandas(_decided(threshold), f"gid long, decided array<struct<b:bigint,a:bigint>>, leaders {ROWS}"), "block")
    chunk, salt = F.floor(F.col("pos") / block).alias("chunk"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    packed = rows.join(later, NODE, "left_semi").groupBy("gid", chunk).agg(F.collect_list(held).alias("rows"))
    met = packed.withColumn("salt", F.pmod("chunk", F.lit(SALTS))).join(found.select("gid", "leaders", salt), ["gid", "salt"]).select("gid", "rows", "leaders")
    joins = met.mapInPandas(_joined(threshold), "gid long, b long, a long")
    return found.select("gid", F.explode("decided").alias("x")).select("gid", "x.b", "x.a").unionByName(joins)


def by_bands(held: DataFrame, now: DataFrame, later: DataFrame, threshold: float, n_words: int) -> DataFrame:
    """The same for any number of rows ``now``, of ``banded`` rows: links of those that meet in bands, and leaders by dependency."""
    keyed = bands.exploded(held.join(now, NODE, "left_semi"), *NODE)
    edges = cut(similar(keyed, keyed, threshold, n_words, True), "edges")
    leaders = cut(first_independent(now, edges), "leaders")
    own = edges.join(leaders.withColumnRenamed("pos", "a"), ["gid", "a"], "left_semi").join(leaders.withColumnRenamed("pos", "b"), ["gid", "b"], "left_anti")
    leading = bands.exploded(held.join(leaders, NODE, "left_semi"), *NODE)
    rest = bands.exploded(held.join(later, NODE, "left_semi"), *NODE)
    links = own.unionByName(similar(leading, rest, threshold, n_words, False))
    return links.groupBy("gid", "b").agg(F.min("a").alias("a")).unionByName(leaders.select("gid", F.col("pos").alias("b"), F.col("pos").alias("a")))


def by_rounds(distinct: DataFrame, threshold: float, block: int) -> DataFrame:
    """(CID, MID, fingerprint_bits, canopy) of distinct(CID, MID, fingerprint_bits, first), no group in one task.

    Rounds decide the rows of every group in order, ``block`` at first and
    ``GROWTH`` times as many each time. The first block is compared as a matrix,
    and so are all later rows with its leaders, which takes what a group has
    many of. Of what is left, similar rows meet in bands: a round's leaders
    follow from the links of its rows, and later rows that are similar to one
    leave with it, so that a row meets few others however many its group has.
    A round whose rows would meet in more than ``MEETINGS`` pairs (many alike in
    a row) is halved, down to a block, which is compared as the first one. The
    result is that of one pass.
    """
    if threshold <= 0:
        return distinct.select(*GROUP, "fingerprint_bits", F.lit(1).alias("canopy"))
    groups = cut(distinct.select(*GROUP).distinct().withColumn("gid", F.monotonically_increasing_id()), "groups")
    rows = cut(ranked(distinct, "first", "pos").join(groups, GROUP).select("gid", *GROUP, "fingerprint_bits", "pos"), "ranks")
    left, held, n_words = rows.select(*NODE), None, 1
    top = rows.agg(F.max("pos")).first()[0] or 0
    lo, found = 0, []
    while lo < top:
        if lo and held is None:
            held = cut(bands.banded(rows.join(left, NODE, "left_semi"), NODE, threshold), "bands")
            n_words = bands.width(held)
        hi = lo + block if held is None else _round_end(held.join(left, NODE, "left_semi"), lo, max(lo + block, lo * GROWTH), block, MEETINGS)
        now, later = left.filter(F.col("pos") <= hi), left.filter(F.col("pos") > hi)
        if hi - lo > block:
            mine = by_bands(held, now, later, threshold, n_words)
        else:
            mine = by_block(rows, now, later, threshold, block)
        done = cut(mine, "assigned")
        found.append(done)
        left = cut(left.join(done.select("gid", F.col("b").alias("pos")), NODE, "left_anti"), "left")
        lo = top if left.isEmpty() else hi
    each = reduce(DataFrame.unionByName, found).select("gid", F.col("b").alias("pos"), F.col("a").alias("leader"))
    each = each.join(groups, "gid")
    numbered = ranked(each.select(*GROUP, "leader").filter("pos = leader"), "leader", "canopy")
    placed = each.join(numbered, [*GROUP, "leader"]).select(*GROUP, "pos", F.col("canopy").cast("int"))
    return rows.join(placed, [*GROUP, "pos"]).select(*GROUP, "fingerprint_bits", "canopy")


def _round_end(open_: DataFrame, lo: int, hi: int, block: int, meetings: int) -> int:
    """The last position of a round: ``hi``, or halfway to ``lo`` as often as its rows meet in more than ``meetings`` pairs."""
    ends = [hi]
    while ends[-1] - lo > block:
        ends.append(max(lo + block, lo + (ends[-1] - lo) // 2))
    if len(ends) == 1:
        return hi
    keyed = bands.exploded(open_.filter(F.col("pos") <= hi), *NODE)
    per = keyed.groupBy("gid", "pair", "code").agg(*[F.count_if(F.col("pos") <= e).alias(f"m{i}") for i, e in enumerate(ends)])
    m = per.agg(*[F.coalesce(F.sum(F.col(f"m{i}") * (F.col(f"m{i}") - 1) / 2), F.lit(0.0)).alias(f"m{i}") for i in range(len(ends))]).first()
    return next((e for i, e in enumerate(ends) if m[f"m{i}"] <= meetings), ends[-1])


def in_one_pass(distinct: DataFrame, threshold: float) -> DataFrame:
    """The same for groups that fit a task: fingerprints stream by group and order, and one group's leaders are held."""
    group = [*GROUP, "fingerprint_bits"]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key: tuple = ()
        leaders: list[int] = []
        for batch in batches:
            places = []
            for cid, mid, bits in zip(batch["CID"], batch["MID"], batch["fingerprint_bits"], strict=True):
                if (cid, mid) != key:
                    key, leaders = (cid, mid), []
                own = sum(1 << int(b) for b in bits)
                for place, other in enumerate(leaders, 1):
                    union = (own | other).bit_count()
                    if not union or (own & other).bit_count() / union >= threshold:
                        break
                else:
                    leaders.append(own)
                    place = len(leaders)
                places.append(place)
            yield batch[group].assign(canopy=places)

    ordered = distinct.repartition(*GROUP).sortWithinPartitions(*GROUP, "first")
    return ordered.mapInPandas(fold, "CID string, MID string, fingerprint_bits array<int>, canopy int")


def canopies(feats: DataFrame, threshold: float = 0.6, block: int = BLOCK) -> DataFrame:
    """Greedy leader clustering in each (CID, MID), in order of rxn_vid: add canopy (1, 2, ...).

    Every row joins the earliest leader it resembles, else leads. Equal
    fingerprints share a leader, so only the distinct ones of a group are
    compared, in order of their least rxn_vid. Groups of more than ``block``
    are worked in rounds by a similarity join, others in one pass; the result
    is the same.
    """
    feats = cut(feats, "features")
    distinct = cut(feats.groupBy(*GROUP, "fingerprint_bits").agg(F.min("rxn_vid").alias("first")), "distinct")
    large = cut(distinct.groupBy(*GROUP).agg(F.count("*").alias("n")).filter(F.col("n") > block).select(*GROUP), "large")
    if large.isEmpty():
        placed = in_one_pass(distinct, threshold)
    else:
        some = in_one_pass(distinct.join(large, GROUP, "left_anti"), threshold)
        placed = some.unionByName(by_rounds(distinct.join(large, GROUP, "left_semi"), threshold, block))
    return feats.join(placed, [*GROUP, "fingerprint_bits"])


def _nearest(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for cid, mid, asked, rows in zip(batch["CID"], batch["MID"], batch["asked"], batch["rows"], strict=True):
                s = similarities([r["bits"] for r in asked], [r["bits"] for r in rows])
                # rows come by least id, and a stable sort keeps that order among equals
                best = np.argsort(-s, axis=1, kind="stable")[:, :k]
                at = np.repeat(np.arange(len(asked)), best.shape[1])
                hit = best.ravel()
                yield pd.DataFrame(
                    {
                        "CID": cid,
                        "MID": mid,
                        "query": [asked[i]["first"] for i in at.tolist()],
                        "first": [rows[j]["first"] for j in hit.tolist()],
                        "n": [rows[j]["n"] for j in hit.tolist()],
                        "similarity": s[at, hit],
                    }
                )

    return run


def build_index(feats: DataFrame, similarity: float = 0.6) -> DataFrame:
    """The index of fingerprints: one row for each distinct one of a (CID, MID), with its least rxn_vid ``first``, its rows ``n``, and its bands.

    Two fingerprints of a group that are similar by at least ``similarity``
    share a band, so that a lookup finds them all.
    """
    distinct = feats.groupBy(*GROUP, "fingerprint_bits").agg(F.min("rxn_vid").alias("first"), F.count("*").alias("n"))
    return bands.banded(cut(distinct, "index-rows"), [*GROUP, "first", "n", "fingerprint_bits"], similarity)


def lookup(index: DataFrame, asked: DataFrame) -> DataFrame:
    """(CID, MID, query, first, n, similarity): the fingerprints that meet those of asked(CID, MID, first) in a band, each once."""
    n_words = bands.width(index)
    one = bands.exploded(index.join(asked, [*GROUP, "first"], "left_semi"), *GROUP, "first").withColumnsRenamed({"first": "query", "size": "a", "w": "u"})
    other = bands.exploded(index, *GROUP, "first", "n")
    score = bands.tanimoto(F.col("u"), F.col("w"), F.col("a"), F.col("size"), n_words)
    return one.join(other, [*GROUP, "pair", "code"]).select(*GROUP, "query", "first", "n", score.alias("similarity")).distinct()


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` most similar fingerprints of each query, ties by their least id."""
    near = Window.partitionBy(*GROUP, "query").orderBy(F.desc("similarity"), "first")
    return found.withColumn("_n", F.row_number().over(near)).filter(F.col("_n") <= k).drop("_n")


def by_sizes(index: DataFrame, asked: DataFrame, k: int, block: int) -> DataFrame:
    """The ``k`` best of asked(CID, MID, first, least) among all of their group, in blocks of like sizes.

    ``least`` is a similarity that a query's k-th answer is known to have. Sets
    of a and b bits are similar by at most a / b for a <= b, so that blocks
    whose sizes are too far from a query block's don't meet.
    """
    sized = cut(ranked(index.select(*GROUP, "first", "n", "size", "fingerprint_bits", F.struct("size", "first").alias("o")), "o", "pos").drop("o"), "index-sizes")
    chunk = F.floor((F.col("pos") - 1) / block).alias("chunk")
    held = F.array_sort(F.collect_list(F.struct("first", "n", F.col("fingerprint_bits").alias("bits"))))
    ends = [F.min("size").alias("low"), F.max("size").alias("high")]
    every = sized.groupBy(*GROUP, chunk).agg(held.alias("rows"), *ends)
    queries = sized.join(asked, [*GROUP, "first"]).groupBy(*GROUP, chunk).agg(held.alias("asked"), F.min("least").alias("least"), *[e.alias(f"q{n}") for e, n in zip((F.min("size"), F.max("size")), ("low", "high"), strict=True)])
    most = F.when(F.col("low") > F.col("qhigh"), F.col("qhigh") / F.col("low")).when(F.col("qlow") > F.col("high"), F.col("high") / F.col("qlow")).otherwise(1.0)
    dealt = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    each = queries.drop("chunk").select("*", dealt)
    met = each.join(every.withColumn("salt", F.pmod("chunk", F.lit(SALTS))), [*GROUP, "salt"]).filter(most >= F.col("least")).select(*GROUP, "asked", "rows")
    return _best(met.mapInPandas(_nearest(k), "CID string, MID string, query bigint, first bigint, n bigint, similarity double"), k)


def search(feats: DataFrame, queries: Column, k: int = 5, block: int = BLOCK, similarity: float = 0.6, index: DataFrame | None = None) -> DataFrame:
    """The ``k`` most similar rows of its group for each row that ``queries`` selects: query, place, rxn_vid, similarity.

    Exact, ties by rxn_vid. ``index`` is the table of ``build_index`` of the
    same rows and ``similarity``, built here if none is given. A lookup finds
    every fingerprint that is similar by at least ``similarity``; a query with
    ``k`` rows among those is answered. The others' groups are searched in
    blocks, which skip sizes that the k-th best found so far rules out. Of equal
    fingerprints the ``k`` least rxn_vids can be answers.
    """
    feats = cut(feats.select("rxn_vid", *GROUP, "fingerprint_bits", F.coalesce(queries, F.lit(False)).alias("asks")), "searched")
    index = cut(build_index(feats, similarity), "index") if index is None else index
    ids = index.select(*GROUP, "fingerprint_bits", "first")
    wanted = feats.filter("asks").join(ids, [*GROUP, "fingerprint_bits"]).select(*GROUP, "first").distinct()
    asked = cut(wanted, "asked")
    found = cut(_best(lookup(index, asked), k), "met")
    sure = F.sum(F.when(F.col("similarity") >= similarity, F.least("n", F.lit(k))).otherwise(0)) >= k
    # the k-th best row of all that were found, whatever its similarity, bounds the answer from below
    rows = Window.partitionBy(*GROUP, "query").orderBy(F.desc("similarity"), "first")
    enough = found.withColumn("held", F.sum(F.least("n", F.lit(k))).over(rows))
    state = enough.groupBy(*GROUP, F.col("query").alias("first")).agg(sure.alias("sure"), F.max(F.when(F.col("held") >= k, F.col("similarity"))).alias("least"))
    state = cut(asked.join(state, [*GROUP, "first"], "left").select(*GROUP, "first", F.coalesce("sure", F.lit(False)).alias("sure"), F.coalesce("least", F.lit(0.0)).alias("least")), "state")
    answered = found.filter(F.col("similarity") >= similarity).join(state.filter("sure").select(*GROUP, F.col("first").alias("query")), [*GROUP, "query"], "left_semi")
    open_ = state.filter("not sure").drop("sure")
    best = cut(answered.unionByName(by_sizes(index, open_, k, block)), "nearest")
    numbered = cut(feats.join(ids, [*GROUP, "fingerprint_bits"]).select(*GROUP, "first", "rxn_vid", "asks"), "search-rows")
    least = numbered.withColumn("_n", F.row_number().over(Window.partitionBy(*GROUP, "first").orderBy("rxn_vid"))).filter(F.col("_n") <= k).drop("_n", "asks")
    answers = best.join(least, [*GROUP, "first"])
    order = Window.partitionBy(*GROUP, "query").orderBy(F.desc("similarity"), "rxn_vid")
    top = answers.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).select(*GROUP, F.col("query").alias("first"), "place", "rxn_vid", "similarity")
    who = numbered.filter("asks").select(*GROUP, "first", F.col("rxn_vid").alias("query"))
    return who.join(top, [*GROUP, "first"]).select("query", "place", "rxn_vid", "similarity")
