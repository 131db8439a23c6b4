"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents of about ``shard_words`` words. Its words become
the benchmark's word numbers; places where two neighbouring words are not
neighbours anywhere in the benchmark can't lie inside a window, so the text is
broken there and pieces shorter than the shortest window are left out. The rest
is indexed: suffix order by doubling, the Burrows-Wheeler transform in a
wavelet matrix, and every eighth suffix position sampled. The windows whose last
two words are neighbours somewhere in the shard (no others can occur) are
searched backward through the wavelet ranks together; their occurrences are
located by walking to a sampled position and merged into spans of words.

The benchmark comes in blocks of bounded size, coded in arrays. Each is broadcast;
a worker holds all of them up to ``HOLD_CHARS`` characters of benchmark and
otherwise reads one at a time for each shard.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import free_name, share, shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: ASCII letters in lower case; other ASCII except digits is a space; bytes from 0x80 on belong to words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
SAMPLE = 8
BLOCK_CHARS, HOLD_CHARS = 1 << 22, 1 << 25
#: Windows searched at once.
STEP = 1 << 16


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


class Windows:
    """The windows of some items, in arrays: runs of ``size`` words of an item, or the whole of a shorter item.

    ``words`` holds the items' word numbers one after the other; a window is its
    start in there and its length. Equal windows are one; ``owner`` lists the
    items of each, from ``owners[i]`` to ``owners[i + 1]``. ``by_tail`` lists
    the windows in order of their last two words, ``tails``.
    """

    def __init__(self, items: list[tuple[object, list[bytes]]], size: int = 13):
        self.vocab: dict[bytes, int] = {}
        self.size = size
        self.names: list[str | None] = []
        parts, starts, lengths, owners, at = [], [], [], [], 0
        for item, found in items:
            ids = np.array([self.vocab.setdefault(w, len(self.vocab)) for w in found], dtype=np.int32)
            if not len(ids):
                continue
            n = min(size, len(ids))
            many = len(ids) - n + 1
            parts.append(ids)
            starts.append(np.arange(at, at + many))
            lengths.append(np.full(many, n))
            owners.append(np.full(many, len(self.names)))
            self.names.append(None if item is None else str(item))
            at += len(ids)
        join = lambda xs: np.concatenate(xs).astype(np.int32) if xs else np.zeros(0, np.int32)
        self.words, start, length, owner = join(parts), join(starts), join(lengths), join(owners)
        self.shortest = int(length.min(initial=size))
        item_of = np.repeat(np.arange(len(parts)), [len(x) for x in parts]) if parts else np.zeros(0, np.int64)
        inner = item_of[1:] == item_of[:-1]
        self.edges = np.unique((self.words[:-1].astype(np.int64) << 32 | self.words[1:])[inner])
        # the windows' words from the last one backwards, to find equal ones
        table = np.full((len(start), size), -1, dtype=np.int32)
        for k in range(size):
            some = length > k
            table[some, k] = self.words[start[some] + length[some] - 1 - k]
        order = np.lexsort(table.T) if len(table) else np.zeros(0, np.int64)
        table = table[order]
        first = np.ones(len(table), dtype=bool)
        first[1:] = (table[1:] != table[:-1]).any(axis=1)
        self.start, self.length = start[order][first], length[order][first]
        both = np.unique((np.cumsum(first) - 1) << 32 | owner[order])
        self.owner = (both & 0xFFFFFFFF).astype(np.int32)
        self.owners = np.searchsorted(both >> 32, np.arange(len(self.start) + 1)).astype(np.int32)
        last, before = table[first][:, 0].astype(np.int64), table[first][:, min(1, size - 1)].astype(np.int64)
        tail = np.where(self.length > 1, before << 32 | last, -1 - last)
        self.by_tail = np.argsort(tail, kind="stable").astype(np.int32)
        self.tails = tail[self.by_tail]

    def backwards(self, some: np.ndarray) -> np.ndarray:
        """The word numbers of windows ``some`` from the last one to the first, -1 beyond."""
        back = np.arange(self.size)
        start, length = self.start[some][:, None], self.length[some][:, None]
        return np.where(back < length, self.words[np.maximum(start + length - 1 - back, 0)], -1)

    def possible(self, edges: np.ndarray, single: np.ndarray) -> np.ndarray:
        """Windows whose last two words are among ``edges``, or whose only word is among ``single``."""
        wanted = np.concatenate((edges, -1 - np.unique(single))) if self.shortest == 1 else edges
        begin, end = np.searchsorted(self.tails, wanted), np.searchsorted(self.tails, wanted, side="right")
        number = end - begin
        return self.by_tail[np.arange(number.sum()) - np.repeat(np.cumsum(number) - number - begin, number)]

    def items(self, window: int) -> list[str]:
        """The items of a window that have an id."""
        return [x for i in self.owner[self.owners[window] : self.owners[window + 1]].tolist() if (x := self.names[i]) is not None]


def _ranks(text: np.ndarray) -> np.ndarray:
    """Suffix order of ``text``, whose last symbol is its least and alone, by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[:-k] = rank[k:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        step = np.ones(n, dtype=np.int64)
        step[0] = 0
        step[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(step)
        if rank[order[-1]] == n - 1:
            return order
        k *= 2
        if k >= n:
            return order


class FMIndex:
    """FM-index of a sequence of non-negative integers."""

    def __init__(self, symbols: np.ndarray):
        text = np.append(symbols.astype(np.int64) + 1, 0)
        self.n = len(text)
        order = _ranks(text)
        bwt = text[order - 1]
        self.top = int(text.max())
        self.below = np.zeros(self.top + 2, dtype=np.int64)
        np.cumsum(np.bincount(text, minlength=self.top + 1), out=self.below[1:])
        self.marked = order % SAMPLE == 0
        self.marks = np.concatenate(([0], np.cumsum(self.marked)))
        self.sampled = order[self.marked]
        self.bwt = bwt
        self.levels = max(1, self.top.bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        row = bwt
        for level in range(self.levels - 1, -1, -1):
            bit = (row >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))))
            self.zeros.append(int(self.n - bit.sum()))
            row = np.concatenate((row[bit == 0], row[bit == 1]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs in the first ``i`` places of the transform."""
        low = np.zeros_like(i)
        for depth, level in enumerate(range(self.levels - 1, -1, -1)):
            bit = ((symbol >> level) & 1).astype(bool)
            ones = self.ones[depth]
            one_i, one_low = ones[i], ones[low]
            i = np.where(bit, self.zeros[depth] + one_i, i - one_i)
            low = np.where(bit, self.zeros[depth] + one_low, low - one_low)
        return i - low

    def search(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows (low, high) of each pattern; table holds symbols from the last to the first, -1 beyond."""
        low, high = np.zeros(len(table), np.int64), np.full(len(table), self.n, np.int64)
        live = np.arange(len(table))
        for column in range(table.shape[1]):
            c = table[live, column]
            done = c < 0
            move, c = live[~done], c[~done] + 1
            known = c <= self.top
            high[move[~known]] = low[move[~known]]
            move, c = move[known], c[known]
            low[move] = self.below[c] + self.rank(c, low[move])
            high[move] = self.below[c] + self.rank(c, high[move])
            live = move[high[move] > low[move]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix order, by walking to sampled positions."""
        rows, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        while len(open_ := np.flatnonzero(~self.marked[rows])):
            c = self.bwt[rows[open_]]
            rows[open_] = self.below[c] + self.rank(c, rows[open_])
            steps[open_] += 1
        return self.sampled[self.marks[rows]] + steps


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Their union: sorted, none touching the next."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def scan(texts: list[list[bytes]], windows: Windows) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """For the words of each text of a shard: its merged hit spans (word numbers, end exclusive) and its items."""
    get = windows.vocab.get
    counts = [len(w) for w in texts]
    starts = np.concatenate(([0], np.cumsum(np.array(counts, dtype=np.int64)))).astype(np.int64)
    out: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in texts]
    text = np.concatenate([np.fromiter(map(get, w, repeat(-1)), dtype=np.int64, count=len(w)) for w in texts]) if texts else np.zeros(0, np.int64)
    if not len(text) or not len(windows.start):
        return out
    # joined[i]: words i and i+1 can lie in one window
    pair = (text[:-1] << 32) | text[1:]
    joined = (text[:-1] >= 0) & (text[1:] >= 0)
    here = np.zeros(len(windows.edges), dtype=bool)
    if len(windows.edges):
        at = np.minimum(np.searchsorted(windows.edges, pair), len(windows.edges) - 1)
        joined &= windows.edges[at] == pair
    else:
        joined[:] = False
    inner = starts[1:-1]
    joined[inner[(inner > 0) & (inner < len(text))] - 1] = False
    if len(here):
        here[at[joined]] = True
    first = np.flatnonzero(np.concatenate(([True], ~joined)))
    last = np.append(first[1:], len(text))
    whole = (last - first >= windows.shortest) & (text[first] >= 0)
    first, last = first[whole], last[whole]
    if not len(first):
        return out
    # the kept pieces, each after a separator, with the place of every word
    size = last - first + 1
    ends = np.cumsum(size)
    place = np.arange(ends[-1]) - np.repeat(ends - size, size) + np.repeat(first, size) - 1
    symbols = np.zeros(ends[-1], dtype=np.int64)
    inside = np.ones(len(symbols), dtype=bool)
    inside[ends - size] = False
    symbols[inside] = text[place[inside]] + 1
    possible = windows.possible(windows.edges[here], text[place[inside]])
    index = FMIndex(symbols) if len(possible) else None
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    for begin in range(0, len(possible), STEP):
        asked = possible[begin : begin + STEP]
        table = windows.backwards(asked)
        low, high = index.search(np.where(table >= 0, table + 1, -1))
        found = np.flatnonzero(high > low)
        number = high[found] - low[found]
        which = np.repeat(asked[found], number)
        rows = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number - low[found], number)
        spot = place[index.locate(rows)]
        owner = np.searchsorted(starts, spot, side="right") - 1
        begins = spot - starts[owner]
        for d, x, y in zip(owner.tolist(), begins.tolist(), (begins + windows.length[which]).tolist(), strict=True):
            spans[d].append((x, y))
        for d, w in np.unique(np.stack((owner, which)), axis=1).T.tolist():
            out[d][1].update(windows.items(w))
    return [(merge(s), items) for s, (_, items) in zip(spans, out, strict=True)]


ROW = "n_words long, spans array<array<long>>, items array<string>"


def occurrences(text: Column, blocks: list[Broadcast], hold: bool, shard_words: int = 1 << 18) -> Column:
    """struct(n_words, spans, items) of each text over all blocks of the benchmark, by shards within the Arrow batch."""

    def search(shard: list[str | None]) -> Iterator[tuple[int, list[list[int]], list[str]]]:
        texts = [words(t) for t in shard]
        spans: list[list[tuple[int, int]]] = [[] for _ in shard]
        items: list[set[str]] = [set() for _ in shard]
        for held in blocks:
            for i, (some, names) in enumerate(scan(texts, shared(Windows, held))):
                spans[i] += some
                items[i] |= names
            if not hold:
                del held._value  # read again from the worker's disk for the next shard
        for w, some, names in zip(texts, spans, items, strict=True):
            yield len(w), [list(x) for x in merge(some)], sorted(names)

    def run(texts: pd.Series) -> pd.DataFrame:
        rows, shard, length = [], [], 0
        for text in texts:
            shard.append(text)
            length += len(text or "") // 6
            if length >= shard_words:
                rows += search(shard)
                shard, length = [], 0
        rows += search(shard)
        return pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return F.pandas_udf(run, ROW)(text)


def pieces(found: list[bytes], size: int, most: int) -> Iterator[list[bytes]]:
    """An item's words, in runs of at most ``most`` that together have all its windows."""
    step = max(1, most - size + 1)
    for begin in range(0, max(1, len(found) - size + 1), step):
        yield found[begin : begin + step + size - 1]


def broadcast_blocks(benchmark: DataFrame, size: int, block_chars: int) -> tuple[list[Broadcast], int]:
    """(the benchmark's windows in blocks of about ``block_chars`` characters, all its characters); the driver holds one block at a time.

    Rows come one partition at a time. A longer item is cut into overlapping pieces.
    """
    out: list[Broadcast] = []
    total, length, items = 0, 0, []

    def close() -> None:
        nonlocal length, items
        if items:
            out.append(share(benchmark.sparkSession, Windows(items, size)))
        length, items = 0, []

    for row in benchmark.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        for found in pieces(words(row["text"]), size, max(2 * size, block_chars // 4)):
            items.append((row["item_id"], found))
            length += sum(map(len, found)) + len(found)
            total += length if length >= block_chars else 0
            if length >= block_chars:
                close()
    total += length
    close()
    return out, total


def covered(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def hits(docs: DataFrame, benchmark: DataFrame, size: int = 13, block_chars: int = BLOCK_CHARS, hold_chars: int = HOLD_CHARS) -> DataFrame:
    """Benchmark windows in every document.

    Returns one row per row of ``docs``: doc_id, n_words, n_hit (words inside
    any occurrence of a window), n_items, items (sorted as strings), spans
    ([begin, end) word numbers, merged), contaminated (n_hit > 0 and 20 n_hit
    >= n_words). Null and wordless texts have no words; null and wordless items
    no windows; equal texts under two item_ids count as two items. An item
    whose item_id is null hits like any other but is not among the items.
    Repeated rows get equal results; other columns are not read; an empty
    benchmark hits nothing. No shuffle.
    """
    blocks, total = broadcast_blocks(benchmark, size, block_chars)
    found = occurrences(F.col("text").cast("string"), blocks, total <= hold_chars)
    spans = F.col("o.spans")
    out = docs.select("doc_id", found.alias("o")).select(
        "doc_id", "o.n_words", covered(spans).alias("n_hit"), F.size("o.items").cast("long").alias("n_items"), "o.items", "o.spans"
    )
    return out.withColumn("contaminated", is_contaminated(F.col("n_hit"), F.col("n_words")))


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, size: int = 13, block_chars: int = BLOCK_CHARS, hold_chars: int = HOLD_CHARS
) -> DataFrame:
    """``docs`` without contaminated rows, with all its columns.

    The hits of all blocks of the benchmark are merged before a document is
    judged. Null and wordless texts stay.
    """
    blocks, total = broadcast_blocks(benchmark, size, block_chars)
    name = free_name(docs, "hits")
    found = docs.withColumn(name, occurrences(F.col("text").cast("string"), blocks, total <= hold_chars))
    return found.filter(~is_contaminated(covered(F.col(f"`{name}`.spans")), F.col(f"`{name}`.n_words"))).drop(name)


def items_digest(items: Column) -> Column:
    return F.sha2(F.array_join(items, ","), 256)

