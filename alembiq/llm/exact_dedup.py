"""Exact deduplication by deterministic block naming, in DataFrame functions only.

A text is cut into blocks of ``block_chars`` characters. Blocks get integer
names: the block's XXH64 chooses a bucket and the blocks of one bucket are
sorted and ranked, so the name is (bucket, rank) and two blocks share a name
only if they are equal. Adjacent names are then named in pairs, again and
again, until one name is left; (number of rounds, name) is the document's
identity, free of collisions by construction.

Nearly every bucket holds one block, whose rank is 0 without looking. Each
round therefore shuffles the *distinct* blocks (or pairs) once, with map-side
combining, to find the buckets that hold more than one; only the blocks of
those are sorted, ranked and joined back. A text copied a million times is
combined before it is shuffled. Texts of rows never travel.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import cut, free_name, text_or_empty

SUPER = 16
#: Repeats of one id and text that one row makes; those of more are dealt to tasks in blocks.
REPEATS = 1 << 16


def _ranges(length: Column, step: int) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.ceil(length / step).cast("int") - 1, F.lit(0)))


def blocks(text: Column, block_chars: int) -> Column:
    """Array of consecutive blocks; the empty text has one empty block.

    Two levels of substring keep the cost near linear for very long texts.
    """
    wide = block_chars * SUPER
    supers = F.transform(_ranges(F.length(text), wide), lambda i: F.substr(text, i * wide + 1, F.lit(wide)))
    return F.flatten(
        F.transform(
            supers,
            lambda s: F.transform(
                _ranges(F.length(s), block_chars), lambda j: F.substr(s, j * block_chars + 1, F.lit(block_chars))
            ),
        )
    )


def _ranks(items: DataFrame, name: str) -> DataFrame | None:
    """items(bucket, item) -> (bucket, item, rank) of buckets with several items, None if there are none."""
    distinct = items.groupBy("bucket", "item").agg(F.lit(1).alias("one"))
    crowded = cut(
        distinct.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket"), f"{name}-crowded"
    )
    if crowded.isEmpty():
        return None
    ordered = Window.partitionBy("bucket").orderBy("item")
    return cut(
        distinct.join(crowded, "bucket", "left_semi").select(
            "bucket", "item", (F.row_number().over(ordered) - 1).cast("int").alias("rank")
        ),
        f"{name}-ranks",
    )


def _apply_ranks(state: DataFrame, occurrences: DataFrame, ranks: DataFrame | None) -> DataFrame:
    """Put the ranks of crowded buckets into ``names`` of state(doc_id, sha, names, ...)."""
    if ranks is None:
        return state
    patch = (
        occurrences.join(ranks, ["bucket", "item"])
        .groupBy("doc_id", "sha")
        .agg(F.map_from_entries(F.collect_set(F.struct("pos", "rank"))).alias("patch"))
        .select(F.col("doc_id").alias("p_id"), F.col("sha").alias("p_sha"), "patch")
    )
    fixed = F.transform(
        "names",
        lambda n, i: F.struct(
            n["h"].alias("h"), F.coalesce(F.try_element_at("patch", i), n["r"]).cast("int").alias("r")
        ),
    )
    joined = state.join(patch, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("sha") == F.col("p_sha")), "left")
    return joined.withColumn("names", F.when(F.col("patch").isNull(), F.col("names")).otherwise(fixed)).select(
        *state.columns
    )


def identities(
    docs: DataFrame,
    block_chars: int = 4096,
    bucket: Callable[..., Column] = F.xxhash64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, sha (SHA-256 of the text), level, h, r.

    (level, h, r) is equal for two rows exactly if their texts are. ``bucket``
    is the hash that opens buckets; any function is right, a poor one is slow.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    parts = blocks(F.col("text"), block_chars)
    named = lambda items: F.transform(items, lambda b: F.struct(bucket(b).alias("h"), F.lit(0).alias("r")))
    state = cut(
        base.select("doc_id", F.sha2("text", 256).alias("sha"), named(parts).alias("names"), F.lit(0).alias("level")),
        "names0",
    )
    items = base.select(F.explode(parts).alias("item")).select(bucket(F.col("item")).alias("bucket"), "item")
    if (ranks := _ranks(items, "blocks")) is not None:
        found = base.select("doc_id", F.sha2("text", 256).alias("sha"), F.posexplode(parts).alias("pos", "item"))
        found = found.withColumn("bucket", bucket(F.col("item")))
        state = cut(_apply_ranks(state, found, ranks), "names0-ranked")

    done, level = [state.filter(F.size("names") == 1)], 0
    current = state.filter(F.size("names") > 1)
    while not current.isEmpty():
        level += 1
        pair = lambda i: F.struct(
            F.col("names")[2 * i]["h"].alias("lh"),
            F.col("names")[2 * i]["r"].alias("lr"),
            F.coalesce(F.get("names", 2 * i + 1)["h"], F.lit(0)).alias("rh"),
            F.coalesce(F.get("names", 2 * i + 1)["r"], F.lit(-1)).alias("rr"),
        )
        halves = F.sequence(F.lit(0), F.ceil(F.size("names") / 2).cast("int") - 1)
        pairs = current.select("doc_id", "sha", F.transform(halves, pair).alias("pairs"))
        key = lambda p: bucket(p["lh"], p["lr"], p["rh"], p["rr"])
        following = pairs.select(
            "doc_id",
            "sha",
            F.transform("pairs", lambda p: F.struct(key(p).alias("h"), F.lit(0).alias("r"))).alias("names"),
            F.lit(level).alias("level"),
        )
        found = pairs.select("doc_id", "sha", F.posexplode("pairs").alias("pos", "item"))
        found = found.withColumn("bucket", key(F.col("item")))
        ranks = _ranks(found.select("bucket", "item"), f"pairs{level}")
        state = cut(_apply_ranks(following, found, ranks), f"names{level}")
        done.append(state.filter(F.size("names") == 1))
        current = state.filter(F.size("names") > 1)

    flat = [d.select("doc_id", "sha", "level", F.col("names")[0]["h"].alias("h"), F.col("names")[0]["r"].alias("r")) for d in done]
    out = flat[0]
    for d in flat[1:]:
        out = out.unionByName(d)
    return out


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Groups of equal texts and the row of each that stays.

    Returns one row per row of ``docs``: doc_id, keep_id (largest doc_id of the
    group), group_size, kept, text_sha256, repeat (0, or the ordinal of a row
    that repeats another row's doc_id and text). A null text counts as empty. A null
    doc_id ranks below all others; if a group has only such rows, keep_id is
    null and one of them stays. Of rows equal in doc_id and text exactly one is
    kept. Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    named = identities(docs, id_col=id_col, text_col=text_col, **options)
    name = ["level", "h", "r"]
    # rows equal in id and text are alike in all that is returned: they are counted, and made rows again at the end
    copies = cut(named.groupBy(*name, "doc_id", "sha").agg(F.count("*").alias("n")), "copies")
    groups = cut(copies.groupBy(*name).agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size")), "groups")
    start = F.col("block") * REPEATS
    ordinals = F.sequence(start, F.least(start + REPEATS, F.col("n")) - 1)
    rows = copies.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / REPEATS)))).join(groups, name)
    if not copies.filter(F.col("n") > REPEATS).isEmpty():
        many = rows.filter(F.col("n") > REPEATS).repartition(*name, "doc_id", "block")
        rows = rows.filter(F.col("n") <= REPEATS).unionByName(many)
    spread = rows.withColumn("repeat", F.explode(ordinals))
    return spread.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("repeat") == 0)).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "repeat",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep, with all its columns."""
    groups = cut(exact_groups(docs, id_col, text_col, **options), "exact")
    own_id, own_sha = free_name(docs, "keep_id"), free_name(docs, "keep_sha")
    keep = groups.filter("kept").select(F.col("doc_id").alias(own_id), F.col("text_sha256").alias(own_sha))
    sha = F.sha2(text_or_empty(text_col), 256)
    rows = docs.join(keep, F.col(id_col).eqNullSafe(F.col(own_id)) & (sha == F.col(own_sha)), "left_semi")
    if groups.filter("repeat > 0").isEmpty():
        return rows
    return rows.withColumn(own_sha, sha).dropDuplicates([id_col, own_sha]).drop(own_sha)
