"""Cross-tokenizer alignment: which tokens of two vocabularies end at the same byte, and how often each pair does so in the corpus.

Texts are cut before a single space between two characters that are never
white space. Neither vocabulary has a token that crosses such a place, so that
the tokens of the parts, each with its space before it, are those of the whole
text, and each distinct part of a slice of documents is tokenized and aligned once.

Counting is a cogroup of postings. A slice of documents gives one posting list
for each pair it holds: the documents and how often each has the pair. The
lists are shuffled by the pair's B id (dealt to ``SALTS`` tasks) beside the
corpus-wide counts of its pairs, both as sorted streams that Spark may spill;
every list then gives its documents their share, which is summed by document.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A single space between two characters that no definition of white space includes.
PLACE = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")
#: Characters whose tokens are aligned at a time; a longer text is a slice of its own.
SLICE = 1 << 21
#: Tasks that the lists of one B id are dealt to.
SALTS = 16
_MADE: dict = {}


def byte_of_characters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Aligner:
    """Tokens of parts by both vocabularies, with the groups between common ends and the pairs that end there."""

    def __init__(self, a_file: bytes, b_file: bytes, pattern: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        # a piece with a space after another character could cross the places: then texts stay whole
        self.place = re.compile(r"(?!)") if any("▁" in p.lstrip("▁") for p in pieces) else PLACE
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8") for i, p in enumerate(pieces)]
        made = json.loads(a_file)
        vocabulary, special = made["model"]["vocab"], {t["content"] for t in made["added_tokens"]}
        to_byte = byte_of_characters()
        own = {i: bytes(map(to_byte.__getitem__, token)) for token, i in vocabulary.items() if token not in special}
        self.bytes_a = [own.get(i, b"") for i in range(max(vocabulary.values()) + 1)]
        merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in made["model"]["merges"]]
        if merged == sorted(merged):  # then ids are ranks, and the faster library gives the same tokens
            fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks={token: i for i, token in own.items()}, special_tokens={})
            self.encode_a = lambda texts: [fast.encode_ordinary(t) for t in texts]
        else:
            slow = Tokenizer.from_str(a_file.decode("utf-8"))
            slow.encode_special_tokens = True
            self.encode_a = lambda texts: [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)]
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        texts = lambda n, end: np.array([f"{i}{end}" for i in range(n)], object)
        self.text_a, self.last_a = texts(len(self.bytes_a), ","), texts(len(self.bytes_a), "|")
        self.text_b, self.last_b = texts(len(self.bytes_b), ","), texts(len(self.bytes_b), ";")

    def tokens(self, parts: list[str]) -> tuple[list, list, np.ndarray]:
        """(tokens by A, tokens by B, whole) of each part; tokens that don't join to a part's bytes are left out."""
        a, b = self.encode_a([f" {x}" for x in parts]), self.b.encode(parts, num_threads=1)
        joined = lambda ids, table: b"".join(map(table.__getitem__, ids))
        own = [b" " + x.encode("utf-8") for x in parts]
        every = b"".join(own)
        whole = np.ones(len(parts), bool)
        if joined(chain.from_iterable(a), self.bytes_a) != every or joined(chain.from_iterable(b), self.bytes_b) != every:
            whole[:] = [joined(x, self.bytes_a) == z and joined(y, self.bytes_b) == z for x, y, z in zip(a, b, own, strict=True)]
            a, b = ([x if w else [] for x, w in zip(some, whole.tolist(), strict=True)] for some in (a, b))
        return a, b, whole

    def align(self, parts: list[str]) -> tuple:
        """(whole, n_a, n_b, n_groups, groups as text with a semicolon after each, pair codes) of parts; codes of all in a row."""
        a, b, whole = self.tokens(parts)
        n_a, n_b = (np.array(list(map(len, x)), np.int64) for x in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x), np.int64, count=int(n.sum())) for x, n in ((a, n_a), (b, n_b)))
        if not len(ids_a):
            return whole, n_a, n_b, n_a, [""] * len(parts), ids_a
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        near = np.searchsorted(ends_b, ends_a)
        closes_a = ends_b[near] == ends_a
        last_a, last_b = np.flatnonzero(closes_a), near[closes_a]
        closes_b = np.zeros(len(ids_b), bool)
        closes_b[last_b] = True
        groups = np.bincount(np.repeat(np.arange(len(parts)), n_a)[last_a], minlength=len(parts))
        # a token's place in the text: after the tokens of its own kind and those of the other that its group's order puts before it
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        words = np.empty(len(ids_a) + len(ids_b), object)
        words[np.arange(len(ids_a)) + np.r_[0, last_b + 1][group_a]] = np.where(closes_a, self.last_a[ids_a], self.text_a[ids_a])
        words[np.arange(len(ids_b)) + (last_a + 1)[group_b]] = np.where(closes_b, self.last_b[ids_b], self.text_b[ids_b])
        ends = np.cumsum(n_a + n_b).tolist()
        listed = words.tolist()
        text = ["".join(listed[s:e]) for s, e in zip([0, *ends[:-1]], ends, strict=True)]
        return whole, n_a, n_b, groups, text, ids_b[last_b] << 17 | ids_a[last_a]


def aligner(a_file: bytes, b_file: bytes, pattern: str) -> Aligner:
    key = (hashlib.sha1(a_file).digest(), hashlib.sha1(b_file).digest(), pattern)
    if key not in _MADE:
        _MADE.clear()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _MADE[key] = Aligner(a_file, b_file, pattern)
    return _MADE[key]


def expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


DOCUMENTS = pa.schema(
    [("rid", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups", pa.string()), ("groups_sha256", pa.string())]
)
LISTS = pa.schema([("b", pa.int32()), ("a", pa.int32()), ("n", pa.int64()), ("base", pa.int64()), ("docs", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])
ROWS = pa.schema([*DOCUMENTS, *LISTS])
DDL = (
    "rid long, doc_id long, n_a long, n_b long, n_groups long, groups string, groups_sha256 string,"
    " b int, a int, n long, base long, docs array<int>, times array<int>"
)


def filled(part: pa.RecordBatch) -> pa.RecordBatch:
    """A batch of documents or lists with the other's columns null."""
    have = dict(zip(part.schema.names, part.columns, strict=True))
    return pa.RecordBatch.from_arrays([have[f.name] if f.name in have else pa.nulls(part.num_rows, f.type) for f in ROWS], schema=ROWS)


def slice_rows(own: Aligner, ids: list, texts: list, base: int, keep_groups: bool) -> Iterator[pa.RecordBatch]:
    """The document rows and the posting lists of a slice; its documents are numbered from ``base``."""
    place: dict[str, int] = {}
    split = [[place.setdefault(x, len(place)) for x in own.place.split(t)] if t else [] for t in texts]
    whole, n_a, n_b, sizes, text_of, codes = own.align(list(place))
    starts = np.cumsum(sizes) - sizes
    rows, good, who = [], [], []
    for k, at in enumerate(split):
        at_ = np.array(at, np.int64)
        if not at or not whole[at_].all():
            rows.append((0, 0, 0, "", ""))
            continue
        groups = "".join([text_of[i] for i in at])[:-1]
        digest = hashlib.sha256(groups.encode()).hexdigest()
        rows.append((int(n_a[at_].sum()), int(n_b[at_].sum()), int(sizes[at_].sum()), groups if keep_groups else None, digest))
        good.append(at_)
        who.append(np.full(len(at_), k, np.int64))
    columns = list(zip(*rows, strict=True))
    table = [np.arange(base, base + len(ids)), ids, *columns]
    yield filled(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(table, DOCUMENTS, strict=True)], schema=DOCUMENTS))
    if not good:
        return
    at, doc = np.concatenate(good), np.concatenate(who)
    keys = codes[expand(starts[at], sizes[at])] << 24 | np.repeat(doc, sizes[at])
    keys, times = np.unique(keys, return_counts=True)
    pair, doc = keys >> 24, keys & ((1 << 24) - 1)
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    ends = np.r_[first, len(pair)].astype(np.int32)
    lists = [
        pa.array((pair[first] >> 17).astype(np.int32)),
        pa.array((pair[first] & ((1 << 17) - 1)).astype(np.int32)),
        pa.array(np.add.reduceat(times, first).astype(np.int64)),
        pa.array(np.full(len(first), base, np.int64)),
        pa.ListArray.from_arrays(pa.array(ends), pa.array(doc.astype(np.int32))),
        pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int32))),
    ]
    yield filled(pa.RecordBatch.from_arrays(lists, schema=LISTS))


def postings(docs: DataFrame, a_path: str, b_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = True) -> DataFrame:
    """A table of document rows (b is null) and posting lists (b is not null) of ``docs``.

    Both files are read on the driver and broadcast: their size is the
    vocabularies'. Documents are numbered by task and place; the numbers are
    fixed as the rows are a written table.
    """
    files = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            files.append(docs.sparkSession.sparkContext.broadcast(f.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*[f.value for f in files], pattern)
        base = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            start = chars = 0
            for end in range(1, len(ids) + 1):
                chars += len(texts[end - 1] or "")
                if chars >= SLICE or end == len(ids):
                    yield from slice_rows(own, ids[start:end], texts[start:end], base, keep_groups)
                    base += end - start
                    start, chars = end, 0

    some = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return cut(some.mapInArrow(run, DDL), "postings")


def pair_counts(table: DataFrame) -> DataFrame:
    """(b, a, links, best): how many links of the corpus hold each pair, and whether no pair of its B id has more.

    Lists are summed before the shuffle; a B id has at most as many rows here
    as vocabulary A has tokens.
    """
    counted = table.filter("b is not null").groupBy("b", "a").agg(F.sum("n").alias("links"))
    return counted.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b")))


def align_tokens(docs: DataFrame, a_path: str, b_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = True) -> DataFrame:
    """Align the tokens of a byte-level vocabulary A and a piece vocabulary B over every text.

    A encodes a space and the text, B the text, before which it puts a space
    itself; special tokens' names are ordinary text; ``pattern`` is A's. Returns one row per row of
    ``docs``: doc_id, n_a and n_b (tokens), n_groups, n_links (occurrences that
    end together: one a group, as no token is empty), n_best (links whose pair
    is the commonest of its B id, ties included), count_sum (over the links,
    how often the corpus links their pair), groups (``a1,a2|b1;a3|b2,b3``, null
    unless ``keep_groups``), groups_sha256.

    A null or empty text, and one whose tokens of A or B don't join to its
    bytes, has no tokens: zeros and ''. Null ids and repeated rows are rows of
    their own and count each; other columns are not read; an empty table gives
    no rows.
    """
    table = postings(docs, a_path, b_path, pattern, id_col, text_col, keep_groups)
    lists = table.filter("b is not null").select("b", "a", "base", "docs", "times", F.pmod(F.xxhash64("base"), F.lit(SALTS)).alias("salt"))
    known = pair_counts(table).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    met = lists.join(known.hint("merge"), ["b", "a", "salt"])
    each = met.select("base", "links", "best", F.explode(F.arrays_zip("docs", "times")).alias("x"))
    shares = each.groupBy((F.col("base") + F.col("x.docs")).alias("rid")).agg(
        F.sum(F.when(F.col("best"), F.col("x.times").cast("long")).otherwise(0)).alias("n_best"), F.sum(F.col("x.times") * F.col("links")).alias("count_sum")
    )
    rows = table.filter("b is null").drop("b", "a", "n", "base", "docs", "times")
    filled_in = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")}
    return rows.join(shares, "rid", "left").withColumns(filled_in).select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups", "groups_sha256"
    )
