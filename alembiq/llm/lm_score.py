"""Language-model scoring with a log-frequency Bloom filter.

One pass over the training texts counts n-grams of one to ``ORDERS`` words by
64-bit hash, combined in the worker and packed by segment before the shuffle;
n-grams that are frequent in a chunk are held back and leave a task once.
Counts are quantised to two levels an octave (1, 2, 3, 4, 6, 8, 12, ...): an
n-gram goes into the filter with all levels up to its own, so that a probe of
level after level, until one is missing, gives back the quantised count. The
filter is made of segments chosen by the n-gram's hash; a segment is combined
from a sorted stream of packed counts and sized by what it holds, so the filter
grows with the corpus at ``BITS_PER_ENTRY`` bits an entry.

Segments are broadcast in blocks of at most ``block_bytes``. Up to
``hold_bytes`` together a worker holds them all; beyond that it reads block
after block for each chunk of texts. No more than ``broadcast_bytes`` are
broadcast: a filter that may be larger is never put together. Texts are kept as
chunks of word numbers, and for one length of n-grams after the other each
chunk's distinct n-grams are sent to their segments once, which both builds the
segments and asks them; the levels go back to the chunks. Shuffle files go as
soon as a table is written, so that disk holds the chunks, the n-grams of one
length, and the levels. The scores are the same in all three ways.

Probabilities are smoothed by Dirichlet priors: after the context h, word w has
(c(hw) + m p(w|h')) / (c(h) + m), where h' is h without its first word and m
the prior of the order (``PRIORS``); below that is the unigram (c(w) + 0.5) /
(N + 0.5 (V + 1)). With exact counts each context's probabilities sum to one.
The unigram base score is exact: the counts of frequent words (a table of
bounded size) are broadcast, those of all others are joined.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import cut, share, shared
from .wordhash import C1, C2, WordHashes, mix, pair

cloudpickle.register_pickle_by_value(sys.modules[__name__])

END = np.uint64(0x5851F42D4C957F2D)
ORDERS = 4
#: Weight of the shorter context's probability by length of the n-gram: the more context, the less it takes to believe a count.
PRIORS = {2: 100.0, 3: 10.0, 4: 1.0}
BITS_PER_ENTRY, PROBES = 8, 3
HALF = np.uint64(32)
KEY_BYTES = 5
LOW = np.uint64((1 << 8 * KEY_BYTES) - 1)
CHUNK = 600_000
OFTEN, HELD = 4, 500_000
#: Training tokens that a segment is made for, segments that a task of the shuffle path holds at a time, and keys that it probes at a time.
SEGMENT_TOKENS, BLOCK_SEGMENTS, PROBED = 500_000, 4, 1_000_000
#: Keys of fewer tokens than 2**PLACE_BITS are sorted with their places in the low bits.
PLACE_BITS = 20
MANY = 255
#: The least count of each level, from level 1 on, and the mean count of each level, from level 0 on.
STARTS = np.array(sorted({1 << k for k in range(62)} | {3 << k for k in range(60)}), dtype=np.int64)
MEANS = np.concatenate(([0.0], (STARTS[:-1] + STARTS[1:] - 1) / 2))
COUNTED = "kind int, seg int, once binary, keys binary, counts binary"
BUILT = "kind int, seg int, key long, cnt long, bits binary"


def tokens(texts: list[str | None], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, tokens per text): A-Z in lower case, words between ASCII blanks, then one end."""
    parts, sizes = [], []
    for text in texts:
        w = (text or "").encode("utf-8", "surrogatepass").lower().split()
        parts.append(hashes.of(w))
        parts.append(np.array([END], dtype=np.uint64))
        sizes.append(len(w) + 1)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.array(sizes, dtype=np.int64)


def place_in_text(sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def ngrams(h: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(n, hash of the n-gram that ends at each token). Before a text's first token is one end; longer n-grams start there at the earliest."""
    key = h
    yield 1, key
    for n in range(2, ORDERS + 1):
        key = pair(np.concatenate((np.array([END], dtype=np.uint64), key[:-1])), h) if len(h) else h
        yield n, key


def whole(n: int, place: np.ndarray) -> np.ndarray:
    """Which n-grams lie in their text, the end before it included."""
    return place >= n - 2


def own_keys(n: int, key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A chunk's n-grams. The context of a text's first token, one end, may be in no text of the chunk and is added to the words."""
    return np.append(key, END) if n == 1 else key[whole(n, place)]


def arranged(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the keys by their high bits, where each run of equal keys begins). The order is the same whenever the keys are.

    Two different keys that agree in 44 bits may break a run; the parts stand for the same key, and whoever reads them adds up.
    """
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(keys) < 1 << PLACE_BITS:
        low = np.uint64((1 << PLACE_BITS) - 1)
        packed = keys & ~low | np.arange(len(keys), dtype=np.uint64)
        packed.sort()
        order = (packed & low).astype(np.int64)
    else:
        order = np.argsort(keys, kind="stable")
    k = keys[order]
    return order, np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))


def inverted(order: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The run of each key."""
    out = np.empty(len(order), dtype=np.int32)
    out[order] = np.repeat(np.arange(len(start), dtype=np.int32), np.diff(np.append(start, len(order))))
    return out


def chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about CHUNK tokens."""
    sizes = batch.column("size").to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        total += n // 6 + 1
        if total >= CHUNK:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)


def levels(count: np.ndarray) -> np.ndarray:
    return np.searchsorted(STARTS, count, side="right")


def segment_of(keys: np.ndarray, n_segments: int) -> np.ndarray:
    """Segments are equal ranges of the hash, so that sorted keys are in order of segment."""
    return (((keys >> HALF) * np.uint64(n_segments)) >> HALF).astype(np.int64)


def _places(keys: np.ndarray, level: int, bits: np.ndarray) -> Iterator[np.ndarray]:
    """Bit numbers below ``bits`` (less than 2**32) of a key's low bits at a level, one array for each probe."""
    g = mix((keys & LOW) + np.uint64(level * int(C1) & (1 << 64) - 1))
    step = g * C2
    for k in range(PROBES):
        yield (((g + step * np.uint64(k)) >> HALF) * bits >> HALF).astype(np.int64)


def build_segment(keys: np.ndarray, counts: np.ndarray) -> bytes:
    level = levels(counts)
    n = max(64, -(-int(level.sum()) * BITS_PER_ENTRY // 64) * 64)
    bits = np.zeros(n, dtype=bool)
    for j in range(1, int(level.max(initial=0)) + 1):
        some = keys[level >= j]
        for place in _places(some, j, np.uint64(n)):
            bits[place] = True
    return np.packbits(bits, bitorder="little").tobytes()


class Filter:
    """A block of segments first, first+1, ... of one kind."""

    def __init__(self, first: int, segments: list[bytes]):
        self.first = first
        sizes = np.array([len(s) for s in segments], dtype=np.int64)
        self.bits = (sizes * 8).astype(np.uint64)
        self.offset = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64) * 8
        self.data = np.frombuffer(b"".join(segments), dtype=np.uint8)

    def probe(self, keys: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Quantised level of each key, by probing level after level."""
        out = np.zeros(len(keys), dtype=np.uint8)
        live = np.arange(len(keys))
        level = 0
        while len(live):
            level += 1
            at = segment[live] - self.first
            bits, base, hit = self.bits[at], self.offset[at], np.ones(len(live), dtype=bool)
            for place in _places(keys[live], level, bits):
                p = place + base
                hit &= (self.data[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
            live = live[hit]
            out[live] = level
        return out


def smoothed(counts: list[np.ndarray], contexts: list[np.ndarray], n: int, v: int) -> np.ndarray:
    """Probabilities from the counts of 1-grams, 2-grams, ... and those of the contexts of 2-grams, 3-grams, ..."""
    p = np.minimum(1.0, (counts[0] + 0.5) / (n + 0.5 * (v + 1)))
    for order, (c, context) in enumerate(zip(counts[1:], contexts, strict=True), 2):
        # no n-gram is more frequent than its context, whatever the filter says
        p = (np.minimum(c, context) + PRIORS[order] * p) / (context + PRIORS[order])
    return p


class Chunk:
    """The tokens of some texts and their distinct n-grams of each length."""

    def __init__(self, h: np.ndarray, sizes: np.ndarray):
        self.h, self.sizes = h, sizes
        self.starts, self.place = np.cumsum(sizes) - sizes, place_in_text(sizes)
        self.keys: dict[int, np.ndarray] = {}
        self.inverse: dict[int, np.ndarray] = {}
        for n, key in ngrams(h):
            own = own_keys(n, key, self.place)
            order, start = arranged(own)
            self.keys[n], self.inverse[n] = own[order[start]], inverted(order, start)

    def scores(self, level: dict[int, np.ndarray], n: int, v: int) -> np.ndarray:
        """log10 probability of each text, from the levels of the distinct n-grams."""
        counts, contexts = [], []
        for order in range(1, ORDERS + 1):
            inside = whole(order, self.place)
            found = MEANS[level[order]][self.inverse[order]]
            if order == 1:
                contexts.append(np.concatenate((found[-1:], found[:-2])))
                counts.append(found[:-1])
                continue
            c = np.zeros(len(self.h))
            c[inside] = np.minimum(found, contexts[-1][inside])
            counts.append(c)
            if order < ORDERS:
                context = np.concatenate(([0.0], c[:-1]))
                context[~whole(order + 1, self.place)] = 0
                contexts.append(context)
        return np.add.reduceat(np.log10(smoothed(counts, contexts, n, v)), self.starts)


class Model:
    """Blocks of the filter for each kind (words of an n-gram), as broadcast variables."""

    def __init__(self, blocks: dict[int, list[tuple[int, int, object]]], n_segments: int, hold: bool):
        self.blocks, self.n_segments, self.hold = blocks, n_segments, hold

    def levels(self, chunk: Chunk) -> dict[int, np.ndarray]:
        """Each block is read once; keys are in order of segment, so that a block's are one range of them."""
        out = {}
        for kind, keys in chunk.keys.items():
            segment = segment_of(keys, self.n_segments)
            out[kind] = np.zeros(len(keys), dtype=np.uint8)
            for first, last, held in self.blocks[kind]:
                a, b = np.searchsorted(segment, (first, last))
                if a < b:
                    out[kind][a:b] = shared(Filter, held).probe(keys[a:b], segment[a:b])
                    if not self.hold:
                        del held._value  # read again from the worker's disk for the next chunk
        return out


def pack(kind: int, keys: np.ndarray) -> bytes:
    """Keys as bytes: whole for words, whose counts are exact; the low 40 bits of longer n-grams, which hardly ever agree within a segment."""
    raw = keys.astype("<u8").view(np.uint8).reshape(-1, 8)
    return (raw if kind == 1 else raw[:, :KEY_BYTES]).tobytes()


def unpack(kind: int, data: bytes) -> np.ndarray:
    if kind == 1:
        return np.frombuffer(data, dtype="<u8")
    raw = np.frombuffer(data, dtype=np.uint8).reshape(-1, KEY_BYTES)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :KEY_BYTES] = raw
    return out.reshape(-1).view("<u8")


def combine(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    if not len(k):
        return k, c.astype(np.int64)
    order = np.argsort(k)
    k = k[order]
    start = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    return k[start], np.add.reduceat(c[order], start, dtype=np.int64)


def runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal neighbours."""
    if len(values):
        first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))).tolist()
        yield from zip(first, [*first[1:], len(values)], strict=True)


def _counter(n_segments: int):
    def packed(kind: int, key: np.ndarray, cnt: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = []
        seg = segment_of(key, n_segments)
        for x, y in runs(seg):
            one = cnt[x:y] == 1
            rows.append((kind, int(seg[x]), pack(kind, key[x:y][one]), pack(kind, key[x:y][~one]), cnt[x:y][~one].astype("<i8").tobytes()))
        if rows:
            types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            columns = [pa.array(x, type=t) for x, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "seg", "once", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {n: [] for n in range(1, ORDERS + 1)}
        for batch in batches:
            texts = batch.column("text")
            for begin, end in chunks(batch):
                h, sizes = tokens(texts.slice(begin, end - begin).to_pylist(), hashes)
                place = place_in_text(sizes)
                for kind, keys in ngrams(h):
                    key, cnt = np.unique(keys[whole(kind, place)], return_counts=True)
                    often = cnt >= OFTEN
                    yield from packed(kind, key[~often], cnt[~often])
                    held[kind].append((key[often], cnt[often]))
                    if sum(len(k) for k, _ in held[kind]) > HELD:
                        key, cnt = combine(*zip(*held[kind], strict=True))
                        held[kind] = [(key, cnt)]
                        if len(key) > HELD // 2:
                            yield from packed(kind, key, cnt)
                            held[kind] = []
        for kind, some in held.items():
            if some:
                yield from packed(kind, *combine(*zip(*some, strict=True)))

    return run


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by kind and segment; a segment's are combined as they come, so that repeats of a hot n-gram don't pile up."""
    at, keys, counts, waiting = None, [], [], 0

    def finish() -> pa.RecordBatch:
        kind, seg = at
        key, cnt = combine(keys, counts)
        bits = build_segment(key, cnt)
        listed = len(key) if kind == 1 else 0
        columns = {
            "kind": pa.array(np.full(listed + 1, kind, np.int32)),
            "seg": pa.array(np.full(listed + 1, seg, np.int32)),
            "key": pa.array(np.concatenate((key[:listed].view(np.int64), [0]))),
            "cnt": pa.array(np.concatenate((cnt[:listed], [0]))),
            "bits": pa.array([None] * listed + [bits], type=pa.binary()),
        }
        return pa.RecordBatch.from_pydict(columns)

    for batch in batches:
        for kind, seg, once, more, n in zip(*(batch.column(c) for c in ("kind", "seg", "once", "keys", "counts")), strict=True):
            here = (kind.as_py(), seg.as_py())
            if here != at:
                if at:
                    yield finish()
                at, keys, counts, waiting = here, [], [], 0
            own = [unpack(at[0], once.as_py()), unpack(at[0], more.as_py())]
            keys += own
            counts += [np.ones(len(own[0]), np.int64), np.frombuffer(n.as_py(), "<i8")]
            waiting += len(own[0]) + len(own[1])
            if waiting > 1_000_000:
                key, cnt = combine(keys, counts)
                keys, counts, waiting = [key], [cnt], 0
    if at:
        yield finish()


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(*more, text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("size"))


def token_estimate(training: DataFrame) -> float:
    return _sized(training).agg(F.sum(F.col("size") / 6 + 1)).first()[0] or 0


def count(training: DataFrame, n_segments: int) -> DataFrame:
    """Table kind, seg, key, cnt, bits of training(text).

    Words (kind 1) are listed with their counts; each segment of every kind
    has one row more, with its part of the filter.
    """
    counted = _sized(training).mapInArrow(_counter(n_segments), COUNTED)
    dealt = counted.repartition("kind", "seg").sortWithinPartitions("kind", "seg")
    return cut(dealt.mapInArrow(_segments, BUILT), "ngrams", clean=True)


def frequent(unigrams: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the most frequent words, at most ``most``, cut where a count class ends."""
    class_ = F.floor(F.log2("cnt") * 8)
    sizes = unigrams.groupBy(class_.alias("c")).agg(F.count("*").alias("n")).orderBy(F.desc("c")).collect()
    least, total = None, 0
    for row in sizes:
        total += row["n"]
        if total > most:
            break
        least = row["c"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    table = unigrams.filter(class_ >= least).select("key", "cnt").toArrow()
    keys = table.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], table.column("cnt").to_numpy()[order]


def load_blocks(built: DataFrame, kind: int, block_bytes: int) -> list[tuple[int, int, object]]:
    """Broadcast the filter of a kind in blocks; the driver holds one block at a time."""
    out: list[tuple[int, int, object]] = []
    first, next_, parts, size = 0, 0, [], 0

    def close() -> None:
        nonlocal first, parts, size
        if next_ > first:
            out.append((first, next_, share(built.sparkSession, Filter(first, parts))))
        first, parts, size = next_, [], 0

    rows = built.filter((F.col("kind") == kind) & F.col("bits").isNotNull()).select("seg", "bits").orderBy("seg")
    for row in rows.toLocalIterator():
        while next_ < row["seg"]:  # a segment without n-grams
            parts.append(bytes(8))
            next_ += 1
        parts.append(bytes(row["bits"]))
        next_, size = next_ + 1, size + len(row["bits"])
        if size >= block_bytes:
            close()
    close()
    return out


SCORED = "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<long>"


def scored(chunk: Chunk, level: dict[int, np.ndarray], ids: pa.Array, held: pa.Array, serial: int, known: tuple, n: int, v: int) -> pa.RecordBatch:
    """A row for each text of a chunk; words that are not in the table of frequent ones are listed as rare."""
    keys, counts = known
    own, inverse, starts = chunk.keys[1], chunk.inverse[1][:-1], chunk.starts
    at = np.minimum(np.searchsorted(keys, own), max(0, len(keys) - 1))
    common = keys[at] == own if len(keys) else np.zeros(len(own), bool)
    base = np.zeros(len(own))
    base[common] = np.log10(counts[at[common]] + 0.5)
    rest = np.add.reduceat((~common[inverse]).astype(np.int64), starts)
    rare = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(rest))).astype(np.int32), pa.array(chunk.h[~common[inverse]].view(np.int64)))
    columns = {
        "rid": pa.array(np.arange(serial, serial + len(starts))),
        "doc_id": ids,
        "held_out": held,
        "n_tokens": pa.array(chunk.sizes),
        "n_known": pa.array(chunk.sizes - rest),
        "base": pa.array(np.add.reduceat(base[inverse], starts)),
        "score": pa.array(chunk.scores(level, n, v)),
        "rare": rare,
    }
    return pa.RecordBatch.from_pydict(columns)


def read_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Chunk, pa.Array, pa.Array]]:
    """(number of the first row, chunk, ids, held-out flags); row numbers are unique over all tasks."""
    hashes, serial = WordHashes(), TaskContext.get().partitionId() << 33
    for batch in batches:
        for begin, end in chunks(batch):
            chunk = Chunk(*tokens(batch.column("text").slice(begin, end - begin).to_pylist(), hashes))
            yield serial, chunk, batch.column("doc_id").slice(begin, end - begin), batch.column("held_out").slice(begin, end - begin)
            serial += end - begin


def score_by_broadcast(sized: DataFrame, model: Model, known, n: int, v: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for serial, chunk, ids, held in read_chunks(batches):
            yield scored(chunk, model.levels(chunk), ids, held, serial, known.value, n, v)

    return sized.mapInArrow(run, SCORED)


TEXTS = "serial long, trains boolean, ids array<long>, held array<boolean>, sizes array<long>, words binary, places binary"


def _tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk of training texts or of others: its distinct words, commonest first, and which of them each token is, in planes of a byte."""
    hashes, serial = WordHashes(), TaskContext.get().partitionId() << 33
    types = (pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary())
    for batch in batches:
        for trains in (True, False):
            part = batch.filter(pc.equal(batch.column("trains"), trains))
            for begin, end in chunks(part):
                text, ids, held = (part.column(c).slice(begin, end - begin).to_pylist() for c in ("text", "doc_id", "held_out"))
                h, sizes = tokens(text, hashes)
                order, start = arranged(h)
                commonest = np.argsort(-np.diff(np.append(start, len(h))), kind="stable")
                rank = np.empty(len(start), dtype="<u4")
                rank[commonest] = np.arange(len(start))
                places = rank[inverted(order, start)].view(np.uint8).reshape(-1, 4).T
                row = (serial, trains, ids, held, sizes.tolist(), h[order[start[commonest]]].astype("<u8").tobytes(), places.tobytes())
                columns = [pa.array([x], type=t) for x, t in zip(row, types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["serial", "trains", "ids", "held", "sizes", "words", "places"])
                serial += 1


def token_hashes(words: bytes, places: bytes) -> np.ndarray:
    """The tokens of a row of TEXTS."""
    place = np.frombuffer(places, dtype=np.uint8).reshape(4, -1).T.copy().view("<u4")[:, 0]
    return np.frombuffer(words, dtype="<u8")[place]


def binaries(data: bytes, ends: np.ndarray) -> pa.Array:
    """A value from each end to the next."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype("<i4")), pa.py_buffer(data)])


ASKED = "block int, serial long, trains boolean, fills binary, keys binary, counts binary, many binary"


def _asker(kind: int, n_segments: int, width: int):
    """A chunk's distinct n-grams of a kind, a row for each block of ``width`` segments: keys in each segment, keys, and the counts where it trains."""
    n_blocks = -(-n_segments // width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for serial, trains, sizes, words, places in zip(*(batch.column(c).to_pylist() for c in ("serial", "trains", "sizes", "words", "places")), strict=True):
                h = token_hashes(words, places)
                gram = next(key for n, key in ngrams(h) if n == kind)
                own = own_keys(kind, gram, place_in_text(np.array(sizes, dtype=np.int64)))
                if not len(own):
                    continue
                order, start = arranged(own)
                key = own[order[start]]
                fills = np.bincount(segment_of(key, n_segments), minlength=n_blocks * width)
                ends = np.concatenate(([0], np.cumsum(fills)[width - 1 :: width]))
                # the end that is added to the words is asked for, but is no token
                cnt = np.add.reduceat((order < len(h)).astype(np.int64), start) if trains else np.zeros(0, np.int64)
                many = cnt >= MANY
                columns = {
                    "block": pa.array(np.arange(n_blocks, dtype=np.int32)),
                    "serial": pa.array(np.full(n_blocks, serial)),
                    "trains": pa.array(np.full(n_blocks, trains)),
                    "fills": binaries(fills.astype("<i4").tobytes(), np.arange(n_blocks + 1) * 4 * width),
                    "keys": binaries(pack(kind, key), ends * (8 if kind == 1 else KEY_BYTES)),
                    "counts": binaries(np.minimum(cnt, MANY).astype(np.uint8).tobytes(), ends * trains),
                    "many": binaries(cnt[many].astype("<i8").tobytes(), np.concatenate(([0], np.cumsum(many)))[ends * trains] * 8),
                }
                yield pa.RecordBatch.from_pydict(columns).filter(pa.array(np.diff(ends) > 0))

    return run


ANSWERED = "kind int, block int, serial long, levels binary, counts binary, n long, v long"


def _answerer(kind: int, width: int, n_segments: int):
    """Rows come sorted by block: a block's segments are built from the counts of all its rows, and then give the level of every key.

    For words the exact counts are answered, too, and a row more has the sum and the number of the block's words.
    """

    def finish(block: int, rows: list[tuple]) -> pa.RecordBatch:
        serial, trains, fills, keys, counts, many = zip(*rows, strict=True)
        first, fill = block * width, np.frombuffer(b"".join(fills), dtype="<i4").reshape(-1, width)
        size = fill.sum(axis=1)
        ends = np.concatenate(([0], np.cumsum(size)))
        segment = np.repeat(np.tile(np.arange(width), len(fill)), fill.ravel())
        key = unpack(kind, b"".join(keys))
        if kind > 1:
            key |= segment.astype(np.uint64) << np.uint64(8 * KEY_BYTES)
        cnt = np.frombuffer(b"".join(counts), dtype=np.uint8).astype(np.int64)
        cnt[cnt == MANY] = np.frombuffer(b"".join(many), dtype="<i8")
        listed = key[np.repeat(np.array(trains), size)]
        known, total = combine([listed[cnt > 0]], [cnt[cnt > 0]])
        within = segment_of(known, n_segments) - first if kind == 1 else known >> np.uint64(8 * KEY_BYTES)
        begin = np.searchsorted(within, np.arange(width + 1))
        filter_ = Filter(first, [build_segment(known[a:b], total[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)])
        level = [filter_.probe(key[i : i + PROBED], segment[i : i + PROBED] + first) for i in range(0, len(key), PROBED)]
        columns = [pa.array(serial, pa.int64()), binaries(np.concatenate(level).tobytes(), ends), pa.nulls(len(rows), pa.binary())]
        sums = [None] * len(rows), [None] * len(rows)
        if kind == 1:
            at = np.minimum(np.searchsorted(known, key), max(0, len(known) - 1))
            exact = np.where(known[at] == key, total[at], 0) if len(known) else np.zeros(len(key), np.int64)
            columns[2] = binaries(exact.astype("<i8").tobytes(), ends * 8)
            columns = [pa.concat_arrays([x, pa.nulls(1, x.type)]) for x in columns]
            sums = [*sums[0], int(total.sum())], [*sums[1], len(known)]
        place = [pa.array([x] * len(columns[0]), pa.int32()) for x in (kind, block)]
        return pa.RecordBatch.from_arrays([*place, *columns, *(pa.array(x, pa.int64()) for x in sums)], names=["kind", "block", "serial", "levels", "counts", "n", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            for x, y in runs(blocks):
                if blocks[x] != at:
                    if rows:
                        yield finish(at, rows)
                    at, rows = int(blocks[x]), []
                columns = (batch.column(c).slice(x, y - x).to_pylist() for c in ("serial", "trains", "fills", "keys", "counts", "many"))
                rows += zip(*columns, strict=True)
        if rows:
            yield finish(at, rows)

    return run


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scorer(n: int, v: int):
    """Rows come sorted by chunk: its tokens, and then the levels of its keys by kind and block, which is the order of the keys."""
    floor = float(np.log10(n + 0.5 * (v + 1)))

    def finish(text: tuple, answers: dict[int, list[tuple[bytes, bytes | None]]]) -> pa.RecordBatch:
        ids, held, sizes, words, places = text
        chunk = Chunk(token_hashes(words, places), np.array(sizes, dtype=np.int64))
        level = {kind: np.frombuffer(b"".join(x for x, _ in answers.get(kind, [])), dtype=np.uint8) for kind in chunk.keys}
        count = np.frombuffer(b"".join(x for _, x in answers[1]), dtype="<i8")
        own = chunk.inverse[1][:-1]
        base = np.add.reduceat(np.log10(count + 0.5)[own], chunk.starts) - chunk.sizes * floor
        columns = {
            "doc_id": pa.array(ids, pa.int64()),
            "held_out": pa.array(held, pa.bool_()),
            "n_tokens": pa.array(chunk.sizes),
            "n_known": pa.array(np.add.reduceat((count > 0)[own].astype(np.int64), chunk.starts)),
            "train_tokens": pa.array(np.full(len(sizes), n)),
            "base_score": pa.array(base),
            "score": pa.array(chunk.scores(level, n, v)),
        }
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, answers = None, {}
        for batch in batches:
            for kind, levels_, counts, *tokens_ in zip(*(batch.column(c).to_pylist() for c in ("kind", "levels", "counts", "ids", "held", "sizes", "words", "places")), strict=True):
                if kind:
                    answers.setdefault(kind, []).append((levels_, counts))
                    continue
                if text:
                    yield finish(text, answers)
                text, answers = tuple(tokens_), {}
        if text:
            yield finish(text, answers)

    return run


def score_by_shuffle(sized: DataFrame, n_segments: int) -> DataFrame:
    """Scores of sized(doc_id, held_out, trains, text, size) without a filter in one place.

    Answers carry no keys: a chunk's keys are in order of block, so the levels
    of its blocks, in that order, are those of its keys. A block holds the keys
    of ``BLOCK_SEGMENTS`` segments, repeats in other chunks included.
    """
    width = min(BLOCK_SEGMENTS, n_segments)
    texts = cut(sized.mapInArrow(_tokenize, TEXTS), "lm-chunks", clean=True, compression="zstd")
    grams, answers = texts.select("serial", "trains", "sizes", "words", "places"), {}
    for kind in range(1, ORDERS + 1):
        asked = grams.mapInArrow(_asker(kind, n_segments, width), ASKED)
        dealt = asked.repartition("block").sortWithinPartitions("block", "serial")
        answers[kind] = cut(dealt.mapInArrow(_answerer(kind, width, n_segments), ANSWERED), "lm-levels", clean=True, compression="zstd")
    totals = answers[1].agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    both = texts.select("serial", F.lit(0).alias("kind"), F.lit(0).alias("block"), "ids", "held", "sizes", "words", "places")
    for found in answers.values():
        both = both.unionByName(found.filter("serial is not null").drop("n", "v"), allowMissingColumns=True)
    scored_ = both.repartition("serial").sortWithinPartitions("serial", "kind", "block").mapInArrow(_scorer(int(totals[0]), int(totals[1])), SCORES)
    return cut(scored_, "scored", clean=True)


def score_texts(
    docs: DataFrame,
    training: Column,
    held_out: Column,
    frequent_words: int = 1 << 19,
    block_bytes: int = 1 << 25,
    hold_bytes: int = 1 << 26,
    broadcast_bytes: int = 1 << 30,
) -> DataFrame:
    """Score every text of docs(doc_id, text) by a model of the rows where ``training`` holds.

    Returns one row per row: doc_id, held_out, n_tokens, n_known (tokens seen in
    training), train_tokens, base_score (exact unigram log10 probability), score
    (the model's). A null or empty text has one token, the end. With no training row all counts
    are zero. Repeated rows are scored alike and all count in training; extra
    columns are not read.
    """
    spark = docs.sparkSession
    train = docs.filter(training).select("text")
    estimate = token_estimate(train)
    n_segments = int(estimate // SEGMENT_TOKENS) + 1

    def apart() -> DataFrame:
        trains = F.coalesce(training, F.lit(False)).alias("trains")
        return score_by_shuffle(_sized(docs, F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), trains), n_segments)

    # a token adds at most one entry of each order
    if estimate * ORDERS * BITS_PER_ENTRY / 8 > broadcast_bytes:
        return apart()
    built = count(train, n_segments)
    sizes = {r["kind"]: r["size"] for r in built.filter("bits is not null").groupBy("kind").agg(F.sum(F.length("bits")).alias("size")).collect()}
    if (total := sum(sizes.values())) > broadcast_bytes:
        return apart()
    unigrams = built.filter((F.col("kind") == 1) & F.col("bits").isNull()).select("key", "cnt")
    totals = unigrams.agg(F.coalesce(F.sum("cnt"), F.lit(0)), F.count("*")).first()
    n, v = int(totals[0]), int(totals[1])
    known = spark.sparkContext.broadcast(frequent(unigrams, frequent_words))
    sized = _sized(docs, F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"))
    blocks = {kind: load_blocks(built, kind, block_bytes) for kind in range(1, ORDERS + 1)}
    made = score_by_broadcast(sized, Model(blocks, n_segments, total <= hold_bytes), known, n, v)
    made = cut(made, "scored", clean=True)
    found = made.select("rid", F.explode("rare").alias("key")).join(unigrams, "key", "left")
    extra = found.groupBy("rid").agg(
        F.sum(F.log10(F.coalesce(F.col("cnt"), F.lit(0)) + 0.5)).alias("more"), F.count("cnt").alias("known")
    )
    floor = float(np.log10(n + 0.5 * (v + 1)))
    return made.drop("rare").join(extra, "rid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        "score",
    )
