"""SimHash near-deduplication with covering locality-sensitive hashing.

Bit i of a fingerprint is given the vector 1 + i mod 15 of GF(2)^4. Table v
(v = 1..15) keeps the bits whose vector has an odd product with v. The vectors
of three differing bits span at most three of the four dimensions, so some v is
orthogonal to all of them: that table's mask clears every differing bit and the
pair meets there. No pair within the radius is missed.

Equal fingerprints are one class; tables hold classes. A bucket with more than
``bucket_limit`` classes is not paired: the same construction is applied to the
bits its mask cleared, which again misses nothing, until buckets are small or
seven bits (128 classes) are left.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import cut, free_name, row_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RADIUS = 3
STEP = 1 << 16


def fingerprint(text: str | None, shingle_words: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles; 0 if it has no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    join = b" ".join
    for start in range(0, n, STEP):
        some = words[start : start + STEP + shingle_words - 1]
        if len(some) <= shingle_words:
            shingles = [join(some)]
        else:
            shingles = map(join, zip(*(some[k:] for k in range(shingle_words)), strict=False))
        h = np.array([digest(s, seed) for s in shingles], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int32)
    bits = (counts * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle_words: int = 3) -> Column:
    """Fingerprint as a signed long."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle_words) for t in texts], dtype=np.uint64).view(np.int64))

    return F.pandas_udf(run, "long")(text)


def covering(bits: list[int]) -> list[tuple[int, list[int]]]:
    """15 tables over ``bits``: (mask, bits it clears), each radius-3 difference cleared by one of them."""
    tables = []
    for v in range(1, 16):
        keep = [b for i, b in enumerate(bits) if ((1 + i % 15) & v).bit_count() % 2]
        mask = sum(1 << b for b in keep)
        tables.append((mask - (1 << 64) if mask >> 63 else mask, [b for b in bits if b not in keep]))
    return tables


def links(classes: DataFrame, bucket_limit: int = 256) -> DataFrame:
    """Pairs (a < b) of values of classes(fp) that differ in at most three bits, each once.

    Every bucket that is paired is bounded: by ``bucket_limit``, or by the 128
    values that seven open bits allow. A bucket's key is one hash of its table
    and kept bits; buckets that share a hash only add pairs, whose bits are
    compared anyway.
    """
    tables = [((i,), mask, rest) for i, (mask, rest) in enumerate(covering(list(range(64))))]
    rows = classes.select(
        F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))).alias("key")) for (i,), m, _ in tables])).alias("x"),
        "fp",
    ).select("x.t", "x.key", "fp")
    found = []
    while True:
        last = max(len(rest) for _, _, rest in tables) <= 7
        size = rows.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
        size = cut(size, "bucket-sizes")
        paired = size if last else size.filter(F.col("m") <= bucket_limit)
        small = rows.join(paired.select("key"), "key").select("key", "fp")
        other = small.select("key", F.col("fp").alias("b"))
        found.append(
            small.withColumnRenamed("fp", "a")
            .join(other, "key")
            .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS))
            .select("a", "b")
        )
        crowded = size.filter(F.col("m") > bucket_limit).select("key")
        if last or crowded.isEmpty():
            break
        finer = [(path, [m for m, _ in covering(rest)], covering(rest)) for path, _, rest in tables]
        masks = F.array(*[F.array(*[F.lit(m) for m in ms]) for _, ms, _ in finer])
        deeper = F.transform(
            F.get(masks, F.col("t")),
            lambda m, j: F.struct((F.col("t") * 15 + j).alias("t"), F.xxhash64("key", j, F.col("fp").bitwiseAND(m)).alias("key")),
        )
        rows = rows.join(crowded, "key", "left_semi").select(F.explode(deeper).alias("x"), "fp").select("x.t", "x.key", "fp")
        tables = [((*path, j), mask, rest) for path, _, made in finer for j, (mask, rest) in enumerate(made)]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each node's connected component.

    Alternating large-star and small-star rounds; each is two aggregations that
    combine map-side and ends in a table in the shared folder.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "star")
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = cut(hung.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "small")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, bucket_limit: int = 256
) -> DataFrame:
    """Near-duplicate groups: fingerprints at most three bits apart are linked, groups are components.

    Returns one row per row of ``docs``: doc_id, fp (signed long), fingerprint
    (16 hex digits), component_id (least doc_id reachable), links (fingerprints
    linked to this one), root (least fingerprint reachable), th (XXH64 of the
    text). Null and wordless texts have
    fingerprint zero, which links like any other. Null doc_ids do not count for
    component_id; if a component has no other, component_id is null. Repeated
    rows get equal results. Other columns are not read.
    """
    base = cut(
        docs.select(
            F.col(id_col).alias("doc_id"), row_key(id_col, text_col)[1], fingerprints(F.col(text_col).cast("string"), shingle_words).alias("fp")
        ),
        "fingerprints",
    )
    classes = cut(base.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    edges = cut(links(classes.select("fp"), bucket_limit), "links")
    degree = (
        edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    )
    roots = components(edges).join(degree, "node")
    held = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"), F.coalesce("links", F.lit(0)).alias("links")
    )
    held = cut(held, "roots")
    low = held.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut(held.join(low, "root").select("fp", "root", "component_id", "links"), "components")
    return base.join(named, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", F.col("links").cast("long"), "root", "th"
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with exactly one row of each near-duplicate group, with all its columns.

    That of the least doc_id stays, null ids counting as the largest; among
    different texts of that id the one of the least hash; of repeated rows one.
    """
    groups = cut(near_groups(docs, id_col, text_col, **options), "near")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("k")
    own_id, own_th = free_name(docs, "keep_id"), free_name(docs, "keep_th")
    keep = groups.groupBy("root").agg(first).select(F.col("k.doc_id").alias(own_id), F.col("k.th").alias(own_th))
    th = row_key(id_col, text_col)[1]
    rows = docs.join(keep, F.col(id_col).eqNullSafe(F.col(own_id)) & (th == F.col(own_th)), "left_semi")
    if groups.groupBy("doc_id", "th").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return rows
    return rows.withColumn(own_th, th).dropDuplicates([id_col, own_th]).drop(own_th)
