"""Hashes. ``sha2`` stays in the JVM; ``parity`` is BLAKE2b with 256 bits (coarse keys: BLAKE2s with 128) in Arrow batches."""

from __future__ import annotations

import hashlib
import json
import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.pandas_udf(T.StringType())
def _blake(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else hashlib.blake2b(t.encode("utf-8"), digest_size=32).hexdigest())


@F.pandas_udf(T.StringType())
def _blake2s(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else hashlib.blake2s(t.encode("utf-8"), digest_size=16).hexdigest())


def hex_digest(c: Column, mode: str = "sha2") -> Column:
    """64 hex digits of the UTF-8 text."""
    if mode == "parity":
        return _blake(c)
    return F.sha2(c, 256)


def _plain(v: object) -> object:
    """A value as JSON knows it: arrays as lists, NaN as null."""
    if isinstance(v, (list, np.ndarray)):
        return [_plain(x) for x in v]
    return None if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)) else v


@F.pandas_udf(T.StringType())
def parity_state(state: pd.DataFrame) -> pd.Series:
    """A struct as JSON with sorted keys, a blank after commas and colons, ASCII escapes and floats of the fewest digits."""
    rows = state.to_dict(orient="records")
    return pd.Series([json.dumps({k: _plain(v) for k, v in r.items()}, sort_keys=True) for r in rows], dtype="object")


@F.pandas_udf(T.StringType())
def parity_json(texts: pd.Series) -> pd.Series:
    """JSON text written again without blanks and with ASCII escapes."""
    return texts.map(lambda t: None if t is None else json.dumps(json.loads(t), separators=(",", ":")))


def token_hash(prefix: str, tokens: Column, mode: str = "sha2") -> Column:
    return hex_digest(F.array_join(F.concat(F.array(F.lit(prefix)), tokens), "|"), mode)


def key_hash(text: Column, parity_text: Column, mode: str = "sha2") -> Column:
    """32 hex digits of a coarse key: of its text by SHA-256, in parity mode of its JSON by BLAKE2s."""
    return _blake2s(parity_text) if mode == "parity" else F.substring(F.sha2(text, 256), 1, 32)


def token_bits(tokens: Column, bits: int, mode: str = "sha2") -> Column:
    """The bit of every token: the first 32 bits of its hash, modulo the fingerprint's width."""
    width = max(bits, 1)
    if mode == "parity":

        def run(lists: pd.Series) -> pd.Series:
            first = lambda t: int.from_bytes(hashlib.blake2b(t.encode("utf-8"), digest_size=32).digest()[:4], "big")
            return lists.map(lambda some: None if some is None else [first(t) % width for t in some])

        return F.pandas_udf(run, "array<int>")(tokens)
    return F.transform(tokens, lambda t: (F.conv(F.substring(F.sha2(t, 256), 1, 8), 16, 10).cast("long") % width).cast("int"))
