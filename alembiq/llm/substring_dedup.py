"""Substring deduplication with suffix automata of reference shards.

A word goes if a window of ``window`` words over it occurs at another place,
in the same document or any other. Broadcasting automata of the whole corpus to
every worker has no size bound and streams every document past every shard, so
the reference is sharded by content and documents only meet the shards that can
hold their windows:

1. A window's *minimizer* is the least hash of the ``gram`` word grams in it.
   Equal windows have equal minimizers, so only windows of one minimizer can be
   equal. One pass counts the places that are minimizers; what is counted once
   can't be repeated.
2. The repeated minimizers go into a bitmap of at most ``bitmap_bits`` bits,
   which is broadcast. It may admit more (the more the fuller it is), never less.
   Where it would be over an eighth full, it isn't made: the runs of windows of
   every document are shuffled by minimizer to meet the repeated ones, and each
   document is joined with the numbers of its runs that do.
3. Each run of windows with an admitted minimizer is one segment of words; the
   minimizer chooses its shard. Equal segments are combined before the shuffle:
   places that meet there are repeated, so their spans are known, and the shard
   gets the segment once, without places. A shard thus holds one row of a
   segment for each batch that has it, however many rows of the table do.
4. Each minimizer's segments are the reference of one suffix automaton whose
   states carry occurrence counts. The segments are streamed through it for
   their matching statistics; a window that reaches ``window`` words in a state
   with two occurrences is repeated. Runs of them are the maximal spans.
5. Spans are gathered per document and its words removed.

A minimizer with more than ``hot_limit`` places would make one large shard. Its
windows are dealt one by one instead, by a 128-bit digest of their words that
stands for them, so that no task holds them together. Hot minimizers are kept in
a bitmap of bounded size too: what it admits beyond them is dealt the same way,
which changes no result. It is an eighth full at most, as the other one is.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import cut, row_key
from .wordhash import WordHashes, pair

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW, GRAM = 35, 8
BITMAP_BITS, HOT_BITS, HOT_LIMIT = 1 << 28, 1 << 26, 200
FLUSH = 400_000
#: Spans in one row on their way to the documents.
SPANS = 512
PAGE = 32768
#: Bytes of a window's digest; a segment of words is longer (window > DIGEST / 2).
DIGEST = 16


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _slide(x: np.ndarray, width: int, fold) -> np.ndarray:
    """fold over every ``width`` consecutive values, by doubling."""
    have = 1
    out = x
    while have * 2 <= width:
        out = fold(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return fold(out[: len(out) - rest], out[rest:]) if rest else out


def grams(h: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of every ``gram`` (a power of two) consecutive word hashes."""
    k = 1
    while k < gram:
        h = pair(h[:-k], h[k:])
        k *= 2
    return h


def minimizers(h: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(grams, minimizer of every window)."""
    g = grams(h, gram)
    return g, _slide(g, window - gram + 1, np.minimum)


def chosen(g: np.ndarray, v: np.ndarray, width: int) -> np.ndarray:
    """The grams that are the minimizer of some window, each place once."""
    pad = np.zeros(width - 1, dtype=np.uint64)
    return g[g == _slide(np.concatenate((pad, v, pad)), width, np.maximum)]


def _count_places(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = WordHashes(), [], 0

        def flush() -> pa.RecordBatch:
            val, cnt = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(val.view(np.int64)), pa.array(cnt.astype(np.int64))], names=["val", "cnt"])

        for batch in batches:
            for text in batch.column("text"):
                w = words(text.as_py())
                if len(w) >= window:
                    g, v = minimizers(hashes.of(w), window, gram)
                    held.append(chosen(g, v, window - gram + 1))
                    size += len(held[-1])
                    if size >= FLUSH:
                        yield flush()
                        size = 0
        if held:
            yield flush()

    return run


def member(bitmap: np.ndarray, val: np.ndarray) -> np.ndarray:
    """Which values are in a bitmap whose size is a power of two."""
    bit = (val % np.uint64(8 * len(bitmap))).astype(np.int64)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def merged(found: np.ndarray) -> np.ndarray:
    """Rows (did, th, a, b) in order, those of one document that touch as one."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.concatenate(([True], (found[1:, :2] != found[:-1, :2]).any(axis=1)))
    # documents one after the other on one axis, so that one running maximum serves all
    offset = (np.cumsum(new) - 1) * (found[:, 3].max() + 2)
    reach = np.maximum.accumulate(found[:, 3] + offset)
    first = np.flatnonzero(np.concatenate(([True], found[1:, 2] + offset[1:] > reach[:-1])))
    last = np.append(first[1:], len(found)) - 1
    return np.column_stack((found[first, :3], reach[last] - offset[last]))


def runs(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of each run of windows with one minimizer."""
    first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
    return first, np.append(first[1:], len(v))


def _runs(window: int, gram: int):
    """Rows (val, did, th, run): the minimizer of each run of each document, and the run's number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = WordHashes(), [], 0

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["val", "did", "th", "run"])

        for batch in batches:
            for text, did, th in zip(batch.column("text"), batch.column("did").to_pylist(), batch.column("th").to_pylist(), strict=True):
                w = words(text.as_py())
                if len(w) >= window:
                    _, v = minimizers(hashes.of(w), window, gram)
                    val = v[runs(v)[0]].view(np.int64)
                    n = len(val)
                    held.append((val, np.full(n, did, np.int64), np.full(n, th, np.int64), np.arange(n, dtype=np.int64)))
                    size += n
                    if size >= FLUSH:
                        yield flush()
                        size = 0
        if held:
            yield flush()

    return run


def _segments(window: int, gram: int, shared=None):
    """Segments of admitted runs: those of the broadcast bitmaps, else of column ``admitted``, twice a run's number, and one if it is hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, hot = shared.value if shared else (None, None)
        hashes = WordHashes()
        held: dict[tuple[int, bytes], list[int]] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            """Segments with their one place, or none if they have several; the spans of those, dealt evenly, without a segment."""
            shards, segs, places, known = [], [], [], []
            for (shard, seg), at in held.items():
                shards.append(shard)
                segs.append(seg)
                places.append(np.array(at, dtype="<i8").tobytes() if len(at) == 3 else b"")
                if len(at) > 3:
                    rows = np.array(at, dtype="<i8").reshape(-1, 3)
                    size_ = window if len(seg) == DIGEST else seg.count(b" ") + 1
                    known.append(np.column_stack((rows, rows[:, 2] + size_)))
            held.clear()
            if known:
                spans = merged(np.concatenate(known))
                for k in range(0, len(spans), SPANS):
                    shards.append(int(spans[k, 0] ^ spans[k, 1]))
                    segs.append(None)
                    places.append(spans[k : k + SPANS].astype("<i8").tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(shards, dtype=np.int64)), pa.array(segs, type=pa.binary()), pa.array(places, type=pa.binary())],
                names=["shard", "seg", "places"],
            )

        for batch in batches:
            listed = repeat(None) if shared else batch.column("admitted")
            ids = batch.column("did").to_pylist(), batch.column("th").to_pylist()
            for text, did, th, code in zip(batch.column("text"), *ids, listed, strict=False):
                w = words(text.as_py())
                if len(w) < window:
                    continue
                _, v = minimizers(hashes.of(w), window, gram)
                first, last = runs(v)
                val = v[first]
                if shared:
                    admitted, is_hot = member(bitmap, val), member(hot, val)
                else:
                    admitted, is_hot = np.zeros((2, len(val)), dtype=bool)
                    codes = code.values.to_numpy(zero_copy_only=False)
                    admitted[codes >> 1] = True
                    is_hot[codes[codes & 1 == 1] >> 1] = True
                for k in np.flatnonzero(admitted).tolist():
                    a, b = int(first[k]), int(last[k])
                    if is_hot[k]:
                        for i in range(a, b):
                            digest = hashlib.blake2b(b" ".join(w[i : i + window]), digest_size=DIGEST).digest()
                            held.setdefault((int.from_bytes(digest[:8], "little", signed=True), digest), []).extend((did, th, i))
                            size += 60
                    else:
                        seg = b" ".join(w[a : b + window - 1])
                        held.setdefault((int(val[k : k + 1].view(np.int64)[0]), seg), []).extend((did, th, a))
                        size += len(seg) + 120
                if size > 16_000_000:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return run


class Automaton:
    """Suffix automaton of several sequences with the number of occurrences of each state."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def add(self, sequence: list, weight: int) -> None:
        nexts, link, length, count = self.next, self.link, self.length, self.count
        last = 0
        for c in sequence:
            q = nexts[last].get(c)
            if q is not None and length[q] == length[last] + 1:
                last = q
                count[last] += weight
                continue
            if q is not None:
                last = self._clone(last, c, q)
                count[last] += weight
                continue
            new = len(nexts)
            nexts.append({})
            length.append(length[last] + 1)
            count.append(weight)
            link.append(0)
            p = last
            while p != -1 and c not in nexts[p]:
                nexts[p][c] = new
                p = link[p]
            if p != -1:
                q = nexts[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
            last = new

    def _clone(self, p: int, c, q: int) -> int:
        nexts, link, length = self.next, self.link, self.length
        clone = len(nexts)
        nexts.append(dict(nexts[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        self.count.append(0)
        link[q] = clone
        while p != -1 and nexts[p].get(c) == q:
            nexts[p][c] = clone
            p = link[p]
        return clone

    def settle(self) -> None:
        """Carry occurrences up the suffix links."""
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]

    def repeated(self, sequence: list, window: int) -> list[int]:
        """Starts of the windows of ``sequence`` that occur twice, from its matching statistics."""
        state, n, out = 0, 0, []
        nexts, link, length, count = self.next, self.link, self.length, self.count
        for i, c in enumerate(sequence):
            while state and c not in nexts[state]:
                state = link[state]
                n = length[state]
            if c in nexts[state]:
                state = nexts[state][c]
                n += 1
            while length[link[state]] >= window:
                state = link[state]
                n = length[state]
            if n >= window and count[state] >= 2:
                out.append(i - window + 1)
        return out


def spans_of(group: list[tuple[bytes, list[bytes]]], window: int) -> Iterator[tuple[list[tuple[int, int]], bytes]]:
    """For one minimizer's segments [(words, places)]: the spans to remove of each, relative, and its places.

    An element of places holds one place, or none where several are settled.
    """
    weights = [sum(1 if p else 2 for p in places) for _, places in group]
    if len(group) == 1:
        seq = group[0][0].split()
        if weights[0] >= 2:
            yield [(0, len(seq))], b"".join(group[0][1])
            return
        if len(seq) == window:
            return
    automaton = Automaton()
    sequences = [seg.split() for seg, _ in group]
    for seq, weight in zip(sequences, weights, strict=True):
        automaton.add(seq, weight)
    automaton.settle()
    for seq, (_, places) in zip(sequences, group, strict=True):
        spans: list[tuple[int, int]] = []
        for i in automaton.repeated(seq, window):
            if spans and i <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + window)
            else:
                spans.append((i, i + window))
        if spans:
            yield spans, b"".join(places)


def _match(window: int):
    def rows(spans: list[tuple[int, int]], places: bytes) -> np.ndarray:
        at = np.frombuffer(places, dtype="<i8").reshape(-1, 3)
        return np.concatenate([np.column_stack((at[:, :2], at[:, 2] + a, at[:, 2] + b)) for a, b in spans])

    def table(found: list[np.ndarray]) -> pa.RecordBatch:
        all_ = np.concatenate(found)
        return pa.RecordBatch.from_arrays([pa.array(all_[:, k].copy()) for k in range(4)], names=["did", "th", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard and segment, spans that are known first; a digest stands for a single window."""
        key, group, waiting, sure, found = None, [], [], False, []

        def finish() -> None:
            if group and len(group[0][0]) != DIGEST:
                found.extend(rows(spans, places) for spans, places in spans_of(group, window))
            group.clear()

        for batch in batches:
            for shard, seg, places in zip(*(batch.column(n).to_pylist() for n in ("shard", "seg", "places")), strict=True):
                if seg is None:
                    found.append(np.frombuffer(places, dtype="<i8").reshape(-1, 4))
                elif len(seg) == DIGEST:
                    if not group or group[0][0] != seg:
                        finish()
                        key, waiting, sure = shard, [], False
                        group.append((seg, []))
                    # one window: its places flow through as soon as there are two
                    waiting.append(places)
                    sure = sure or len(waiting) > 1 or not places
                    if sure:
                        found.extend(rows([(0, window)], p) for p in waiting)
                        waiting = []
                else:
                    if shard != key or not group or len(group[0][0]) == DIGEST:
                        finish()
                        key = shard
                    if group and group[-1][0] == seg:
                        group[-1][1].append(places)
                    else:
                        group.append((seg, [places]))
                if len(found) > 20_000:
                    yield table(found)
                    found = []
        finish()
        if found:
            yield table(found)

    return run


def bitmap_of(values: DataFrame, most_bits: int, n: int) -> np.ndarray:
    """A bitmap of values(val), 16 bits for each of ``n`` up to ``most_bits`` together; pages come to the driver one partition at a time."""
    n_bits = PAGE
    while n_bits < min(most_bits, 16 * n):
        n_bits *= 2
    # val is an unsigned hash kept in a signed long; n_bits is a power of two
    at = F.col("val").bitwiseAND(F.lit(n_bits - 1)) + 1
    pages = values.groupBy(F.bitmap_bucket_number(at).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bitmap = np.zeros(n_bits // 8, dtype=np.uint8)
    for row in pages.toLocalIterator():
        bits = np.frombuffer(row["bits"], dtype=np.uint8)
        begin = (row["page"] - 1) * PAGE // 8
        bitmap[begin : begin + len(bits)] = bits
    return bitmap


def removed_spans(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bitmap_bits: int = BITMAP_BITS, hot_limit: int = HOT_LIMIT, hot_bits: int = HOT_BITS
) -> DataFrame:
    """(did, th, spans): word spans [a, b) to remove, of the documents that lose any."""
    spark = docs.sparkSession
    keyed = docs.select(*row_key(), F.col("text").cast("string").alias("text"))
    places = keyed.select("text").mapInArrow(_count_places(window, gram), "val long, cnt long")
    repeated = cut(places.groupBy("val").agg(F.sum("cnt").alias("cnt")).filter("cnt > 1"), "minimizers")
    hot = F.col("cnt") > hot_limit
    n, n_hot = repeated.agg(F.count("*"), F.count_if(hot)).first()
    made = "shard long, seg binary, places binary"
    if n <= bitmap_bits // 8 and n_hot <= hot_bits // 8:
        shared = spark.sparkContext.broadcast((bitmap_of(repeated, bitmap_bits, n), bitmap_of(repeated.filter(hot), hot_bits, n_hot)))
        segments = keyed.mapInArrow(_segments(window, gram, shared), made)
    else:
        each = keyed.mapInArrow(_runs(window, gram), "val long, did long, th long, run long")
        code = F.shiftleft("run", 1) + hot.cast("long")
        admitted = each.join(repeated, "val").groupBy("did", "th").agg(F.collect_set(code).alias("admitted"))
        segments = keyed.join(admitted, ["did", "th"]).select("text", "did", "th", "admitted").mapInArrow(_segments(window, gram), made)
    shards = segments.repartition("shard").sortWithinPartitions("shard", "seg")
    found = shards.mapInArrow(_match(window), "did long, th long, a long, b long")
    return found.groupBy("did", "th").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("spans"))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Remove every word inside a window of words that also starts elsewhere.

    Windows are judged on the input. Returns one row per row of ``docs``:
    doc_id, n_words, n_removed, kept (remaining words joined by one space). A
    null or wordless text has no words; texts shorter than the window lose
    none. A row stored twice repeats itself, so both copies lose every window.
    Other columns are not read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    gone = removed_spans(base, **options)
    both = base.select("doc_id", "text", *row_key()).join(gone, ["did", "th"], "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 250):
                some = batch.slice(begin, 250)
                n_words, n_removed, kept = [], [], []
                for text, spans in zip(some.column("text"), some.column("spans"), strict=True):
                    w = words(text.as_py())
                    rest = w
                    if spans.is_valid:
                        keep = np.ones(len(w), dtype=bool)
                        for x, y in zip(spans.values.field("a").to_pylist(), spans.values.field("b").to_pylist(), strict=True):
                            keep[x:y] = False
                        rest = [x for x, k in zip(w, keep.tolist(), strict=True) if k]
                    n_words.append(len(w))
                    n_removed.append(len(w) - len(rest))
                    kept.append(b" ".join(rest).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    return both.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
