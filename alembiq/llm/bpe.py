"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are cut where a match of the pattern is sure to end and the next one
does not look back: before a single space between two letters, or before a line
feed between a letter or digit and a visible character. The pieces then encode
to exactly the ids of the whole. A text without such a place, or one with very
long runs, is split by the pattern itself and each match encoded on its own,
which is what the library does inside. Decoding joins raw bytes first and
never decodes single tokens to text.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAFE = regex.compile(r"(?<=\p{L}) (?=\p{L})|(?<=[\p{L}\p{N}])\n(?=\S)")
LONG_RUN = regex.compile(r"\s{2000}|\p{L}{2000}|\p{N}{2000}|[^\s\p{L}\p{N}]{2000}")
_MADE: dict = {}


def load_ranks(path: str) -> bytes:
    """The rank file's bytes. The file is read on the driver and broadcast: its size is the vocabulary's."""
    with open(path, "rb") as f:
        return f.read()


class Codec:
    """Encodes and decodes by one vocabulary."""

    def __init__(self, ranks: bytes, pattern: str, chunk_chars: int = 1 << 16):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.chunk = chunk_chars

    def pieces(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > self.chunk:
            found = SAFE.search(text, start + self.chunk)
            if not found:
                break
            yield text[start : found.start()]
            start = found.start()
        yield text[start:]

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, special tokens' names being ordinary text."""
        ids: list[int] = []
        for piece in self.pieces(text):
            if len(piece) > 2 * self.chunk or LONG_RUN.search(piece):
                for match in self.pattern.finditer(piece):
                    ids += self.encoding._encode_single_piece(match.group().encode("utf-8"))
            else:
                ids += self.encoding.encode_ordinary(piece)
        return np.array(ids, dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return self.encoding.decode_bytes(ids.tolist())


def codec(ranks: bytes, pattern: str) -> Codec:
    key = (hashlib.sha1(ranks).digest(), pattern)
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Codec(ranks, pattern)
    return _MADE[key]


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
        T.StructField("round_trip", T.BooleanType()),
    ]
)


def encode_texts(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True
) -> DataFrame:
    """Token ids of every text and proof that they decode to it.

    Returns one row per row of ``docs``: doc_id, n_tokens, ids (little-endian
    unsigned 32-bit integers, null unless ``keep_ids``), ids_sha256,
    decoded_sha256 (of the decoded bytes), round_trip (they are the text's). A
    null or empty text has no ids. Repeated rows and null doc_ids pass through;
    other columns are not read. No shuffle.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(path))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(ranks.value, pattern)
        for batch in batches:
            for start in range(0, len(batch), 500):
                rows = []
                some = batch.iloc[start : start + 500]
                for text in some["text"]:
                    raw = (text or "").encode("utf-8")
                    ids = own.encode(text or "")
                    back = own.decode(ids)
                    data = ids.tobytes()
                    rows.append((len(ids), data if keep_ids else None, hashlib.sha256(data).hexdigest(), hashlib.sha256(back).hexdigest(), back == raw))
                out = pd.DataFrame(rows, columns=SCHEMA.names[1:])
                out.insert(0, "doc_id", some["doc_id"].array)
                yield out

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInPandas(run, SCHEMA)
