"""Line deduplication by pairwise alignment.

The result is that of aligning every document with every earlier one. Each pair
is aligned by patience diff on line hashes: lines unique on both sides, their
longest increasing run, extended to neighbouring equal lines and refined inside
the gaps. Aligned common blocks are deleted from the later document.

Pairs that can't change the result are not aligned. Nothing but blank lines
aligns unless the two share a line that each has once, or begin or end alike:
these are a document's ``features``. In the first round a feature held by at
most ``rare`` documents pairs all of them, a commoner one pairs each with the
earliest. Only documents that keep a line which an earlier one holds go on: to
growing random parts of their features' holders, at last to all. Documents that
differ only in lines nobody else holds align alike, so that in these rounds the
earliest stands for all of them. What makes few pairs with all holders is
aligned with all of them at once.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import cut, row_key, text_or_empty

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: White space around a line that does not count.
BLANKS = " \t\r\x0b\x0c"
#: Pairs of one earlier document that one task aligns.
PAIRS = 512
#: Pairs with all holders up to which what is left takes one round.
ONCE = 1 << 16


def _anchors(a: list[int], b: list[int], a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Lines that occur once in each range, as a longest run increasing on both sides."""
    in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
    at = {x: i for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and x and in_b.get(x) == 1}
    pairs = [(at[x], j) for j, x in enumerate(b[b0:b1], b0) if x in at]
    tails: list[int] = []
    best: list[int] = []
    back: list[int] = []
    for k, (i, _) in enumerate(pairs):
        p = bisect_left(tails, i)
        if p == len(tails):
            tails.append(i)
            best.append(k)
        else:
            tails[p], best[p] = i, k
        back.append(best[p - 1] if p else -1)
    out, k = [], best[-1] if best else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Blocks [begin, end) of ``b`` that patience diff aligns with ``a``; 0 stands for a blank line."""
    matched: set[int] = set()
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.add(b0)
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.add(b1)
        if a0 >= a1 or b0 >= b1:
            continue
        anchors = _anchors(a, b, a0, a1, b0, b1)
        if not anchors:
            continue
        i0, j0 = a0, b0
        for i, j in anchors:
            matched.add(j)
            todo.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
        todo.append((i0, a1, j0, b1))
    blocks: list[tuple[int, int]] = []
    for j in sorted(matched):
        if blocks and blocks[-1][1] == j:
            blocks[-1] = (blocks[-1][0], j + 1)
        else:
            blocks.append((j, j + 1))
    return blocks


def mixed(line: int, blanks: int, side: int) -> int:
    """A signed long for a line (0: the document's edge) with so many blank lines beside it."""
    x = ((line << 3 | side) * 0x9E3779B97F4A7C15 + blanks * 0xC2B2AE3D27D4EB4F) & (1 << 64) - 1
    x = (x ^ x >> 29) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    x ^= x >> 32
    return x - (1 << 64) if x >> 63 else x


def blank_marks(lines: list[int]) -> list[tuple[int, int]]:
    """(number of a line, mark) of each blank line: how many blanks it is after the line before, and before the one after."""
    out = []
    for side, order in ((1, range(len(lines))), (2, range(len(lines) - 1, -1, -1))):
        near, blanks = 0, 0
        for j in order:
            if lines[j]:
                near, blanks = lines[j], 0
            else:
                blanks += 1
                out.append((j, mixed(near, blanks, side)))
    return out


def held_keys(lines: list[int]) -> dict[int, bool]:
    """What a document holds: its lines and the marks of its blank lines; whether each is a feature, by which it may align."""
    counts = Counter(lines)
    del counts[0]
    out = dict.fromkeys((mark for _, mark in blank_marks(lines)), False)
    out |= {h: n == 1 for h, n in counts.items()}
    if counts:
        first = next(j for j, h in enumerate(lines) if h)
        last = next(j for j, h in enumerate(reversed(lines)) if h)
        out |= {mixed(lines[first], first, 3): True, mixed(lines[-1 - last], last, 4): True}
    return out


def may_lose_more(lines: list[int], sizes: list[int], old: set[int], gone: set[int], least: int) -> bool:
    """Whether a line that stays may be in an aligned block of ``least`` characters.

    Such a block has only blank lines and lines that an earlier document holds
    (``old``). Of blank lines those beside a deleted line count.
    """
    open_lines: set[int] = set()
    begin = 0
    for j in range(len(lines) + 1):
        if j == len(lines) or lines[j] and lines[j] not in old:
            if sum(sizes[begin:j]) >= least:
                open_lines.update(range(begin, j))
            begin = j + 1
    open_lines -= gone
    if any(lines[j] for j in open_lines):
        return True
    texts = [j for j, h in enumerate(lines) if h]
    for j, mark in blank_marks(lines) if open_lines and gone else ():
        if mark in old and j in open_lines:
            k = bisect_left(texts, j)
            if any(x in gone for x in texts[max(0, k - 1) : k + 1]):
                return True
    return False


def shared_keys(seqs: DataFrame) -> DataFrame:
    """(did, th, h, feature, m, e, f) of what more than one document holds; m: holders by feature, e: earliest holder, f: earliest by feature."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for did, th, lines in zip(batch["did"], batch["th"], batch["lines"], strict=True):
                out += [(did, th, h, feature) for h, feature in held_keys(lines.tolist()).items()]
            yield pd.DataFrame(out, columns=["did", "th", "h", "feature"])

    held = seqs.select("did", "th", "lines").mapInPandas(run, "did long, th long, h long, feature boolean")
    doc = F.struct("did", "th")
    every = held.groupBy("h").agg(
        F.count("*").alias("n"), F.count_if("feature").alias("m"), F.min(doc).alias("e"), F.min(F.when(F.col("feature"), doc)).alias("f")
    )
    every = cut(every.filter("n > 1").drop("n"), "shared-lines")
    return cut(held.join(every, "h"), "shared-holders")


def is_later() -> Column:
    return (F.col("e_did") < F.col("did")) | ((F.col("e_did") == F.col("did")) & (F.col("e_th") < F.col("th")))


def first_pairs(shared: DataFrame, rare: int) -> DataFrame:
    """(did, th, e_did, e_th): later and earlier documents that share a feature; of commoner ones the earliest only."""
    by = shared.filter("feature and m > 1")
    common = by.filter(F.col("m") > rare).select("did", "th", F.col("f.did").alias("e_did"), F.col("f.th").alias("e_th"))
    few = by.filter(F.col("m") <= rare).select("h", "did", "th")
    earlier = few.select("h", F.col("did").alias("e_did"), F.col("th").alias("e_th"))
    rarely = few.join(earlier, "h").select("did", "th", "e_did", "e_th")
    return rarely.unionByName(common).filter(is_later()).distinct()


def deleted(made: DataFrame, late: DataFrame, early: DataFrame, least: int, most: int = PAIRS) -> DataFrame:
    """(did, th, j): lines of late(did, th, lines, sizes) aligned with early(did, th, lines), for the pairs ``made``.

    Pairs are gathered by their earlier document, whose lines come once for
    every ``most`` pairs and not with each; a document with more is dealt out.
    The few that are dealt out are a table of their own, so that the join that
    deals them has no aggregation between it and its exchanges and AQE can split it.
    """
    made = cut(made, "line-pairs")
    parts = cut(made.groupBy("e_did", "e_th").agg(F.ceil(F.count("*") / most).cast("int").alias("parts")), "pair-parts")
    firsts = early.select(F.col("did").alias("e_did"), F.col("th").alias("e_th"), F.col("lines").alias("e_lines")).join(parts, ["e_did", "e_th"])
    firsts = firsts.select("e_did", "e_th", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "e_lines")
    split = made.join(parts.filter("parts > 1"), ["e_did", "e_th"], "left")
    dealt = split.withColumn("part", F.pmod(F.xxhash64("did", "th"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    pairs = dealt.join(late.select("did", "th", "lines", "sizes"), ["did", "th"])
    key = ["e_did", "e_th", "part"]
    both = firsts.unionByName(pairs, allowMissingColumns=True).repartition(*key).sortWithinPartitions(*key, F.asc_nulls_first("did"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a: list[int] = []
        for batch in batches:
            out = []
            columns = (batch[c] for c in ("e_lines", "did", "th", "lines", "sizes"))
            for first, did, th, b, size in zip(*columns, strict=True):
                if first is not None:
                    a = first.tolist()
                    continue
                for begin, end in align(a, b.tolist()):
                    if size[begin:end].sum() >= least:
                        out += [(int(did), int(th), j) for j in range(begin, end)]
            yield pd.DataFrame(out, columns=["did", "th", "j"])

    whole = both.select("e_lines", F.col("did").cast("string").alias("did"), F.col("th").cast("string").alias("th"), "lines", "sizes")
    return whole.mapInPandas(run, "did long, th long, j int").distinct()


def unsettled(late: DataFrame, gone: DataFrame, least: int) -> DataFrame:
    """The rows of late(did, th, lines, sizes, old) that may lose more than gone(did, th, j)."""
    lost = gone.groupBy("did", "th").agg(F.collect_set("j").alias("gone"))
    none = F.array().cast("array<int>")

    def run(lines: pd.Series, sizes: pd.Series, old: pd.Series, gone: pd.Series) -> pd.Series:
        rows = zip(lines, sizes, old, gone, strict=True)
        return pd.Series([may_lose_more(a.tolist(), n.tolist(), set(b.tolist()), set(c.tolist()), least) for a, n, b, c in rows], dtype=bool)

    more = F.pandas_udf(run, "boolean")("lines", "sizes", "old", F.coalesce("gone", none))
    return late.join(lost, ["did", "th"], "left").filter(more).drop("gone")


def earliest_alike(held: DataFrame) -> DataFrame:
    """(did, th, lines): of documents of held(did, th, lines, keys) that differ only in lines outside keys the earliest; -1 stands for such lines."""

    def run(lines: pd.Series, keys: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(lines, keys, strict=True):
            known, made = set(b.tolist()), []
            for h in a.tolist():
                if h == 0 or h in known:
                    made.append(h)
                elif not made or made[-1] != -1:
                    made.append(-1)
            out.append(made)
        return pd.Series(out, dtype=object)

    alike = held.select("did", "th", F.pandas_udf(run, "array<long>")("lines", "keys").alias("lines"))
    return alike.groupBy("lines").agg(F.min(F.struct("did", "th")).alias("e")).select("e.did", "e.th", "lines")


def removed_lines(
    docs: DataFrame, rare: int = 8, min_block_chars: int = 24, id_col: str = "doc_id", text_col: str = "text", part: int = 64, once: int = ONCE
) -> DataFrame:
    """(did, th, gone): line numbers to delete from each document that loses any.

    After the first round a document meets about ``part`` holders of each of
    its features, in each further round ``part`` times as many. If those left
    make at most ``once`` pairs with all holders of their features, the round is
    the last one. Neither number changes the result.
    """
    text, least = text_or_empty(text_col), max(1, min_block_chars)
    bare = F.transform(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)))
    hashed = F.transform("bare", lambda x: F.when(x == "", F.lit(0)).otherwise(F.xxhash64(x)))
    lines = docs.select(*row_key(id_col, text_col), bare.alias("bare"))
    seqs = lines.select("did", "th", hashed.alias("lines"), F.transform("bare", F.length).alias("sizes")).dropDuplicates(["did", "th"])
    seqs = cut(seqs, "line-hashes")
    shared = shared_keys(seqs)
    doc = F.struct("did", "th")
    keys = shared.groupBy("did", "th").agg(F.collect_list("h").alias("keys"), F.collect_list(F.when(F.col("e") < doc, F.col("h"))).alias("old"))
    held = cut(seqs.join(keys, ["did", "th"]), "overlapping")
    gone = cut(deleted(first_pairs(shared, rare), held.select("did", "th", "lines", "sizes"), held, least), "aligned")
    late = cut(unsettled(held.filter(F.size("old") > 0).drop("keys"), gone, least), "unsettled")
    by = shared.filter(F.col("feature") & (F.col("m") > rare)).select("did", "th", "h", "m")
    heads, done = None, 0
    reach = F.max("m").alias("most"), F.sum("m").alias("pairs")
    while (left := by.join(late.select("did", "th"), ["did", "th"]).agg(*reach).first())["most"]:
        last = left["pairs"] <= once
        if heads is None and last:
            heads, earlier = held, by.withColumnsRenamed({"did": "e_did", "th": "e_th"})
        elif heads is None:
            heads = cut(earliest_alike(held), "alike")
            earlier = cut(by.join(heads.select("did", "th"), ["did", "th"]).withColumnsRenamed({"did": "e_did", "th": "e_th"}), "alike-features")
        upto = left["most"] if last else max(1, done) * part
        place = F.pmod(F.xxhash64("h", "e_did", "e_th"), F.col("m"))
        some = earlier.filter((place >= done) & (place < upto)).select("h", "e_did", "e_th")
        mine = by.join(late.select("did", "th"), ["did", "th"]).select("h", "did", "th")
        made = mine.join(some, "h").filter(is_later()).select("did", "th", "e_did", "e_th").distinct()
        more = cut(deleted(made, late.select("did", "th", "lines", "sizes"), heads, least), "aligned")
        gone = gone.unionByName(more)
        done = upto
        if done >= left["most"]:
            break
        late = cut(unsettled(late, gone, least), "unsettled")
    return gone.groupBy("did", "th").agg(F.collect_set("j").alias("gone"))


def without(text: Column, gone: Column) -> Column:
    """A text without the lines whose numbers are in ``gone``, in one pass."""

    def run(texts: pd.Series, gone: pd.Series) -> pd.Series:
        out = []
        for text, numbers in zip(texts, gone, strict=True):
            if numbers is not None:
                lines, lost = text.split("\n"), set(numbers.tolist())
                text = "\n".join([x for j, x in enumerate(lines) if j not in lost])
            out.append(text)
        return pd.Series(out, dtype=object)

    return F.pandas_udf(run, "string")(text, gone)


def dedup_lines(docs: DataFrame, rare: int = 8, min_block_chars: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Delete from each document the line blocks it shares with an earlier one.

    Earlier means a smaller doc_id (a null one is the smallest), then a smaller
    text hash; rows equal in doc_id and text are one document and get equal
    results. Lines are compared without the white space around them; blank lines go only
    inside a deleted block; blocks of fewer than ``min_block_chars`` characters
    stay. Every earlier document counts, however many hold a line. Decisions are
    taken on the input. Returns one row per row: doc_id,
    n_lines (0 for a null or empty text), n_removed, kept (the remaining lines,
    joined by line feeds). Other columns are not read.
    """
    gone = removed_lines(docs, rare, min_block_chars, id_col, text_col)
    base = docs.select(F.col(id_col).alias("doc_id"), *row_key(id_col, text_col), text_or_empty(text_col).alias("text"))
    both = base.join(gone, ["did", "th"], "left")
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return both.select(
        "doc_id",
        F.when(F.col("text") == "", 0).otherwise(n_lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        without(F.col("text"), F.col("gone")).alias("kept"),
    )
