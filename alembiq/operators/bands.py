"""Exact similarity join of fingerprints by bands: sets of bits that any two similar fingerprints must share.

Bits are ordered from rare to common. If two sets of a and b bits have a
Tanimoto similarity of at least t, they share at least o = t / (1 + t) * (a + b)
of them, and the first a - o + n bits of one and the first b - o + n of the
other share at least n. So for each size b that a similar set can have, a set
gives a band for every n of its first bits, named by both sizes and the bits;
similar sets meet in a band, and the similarity of those that meet is computed.
n is as large as the number of bands stays small.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bits of a band at most, and bands that the larger of two sets may give for one pair of sizes.
WAYS, MOST = 4, 72
_CHOICES: dict[tuple[int, int], np.ndarray] = {}


def common_bits(a: int, b: int, threshold: float) -> int:
    """The least number of common bits of similar sets of ``a`` and ``b`` bits."""
    return max(1, math.ceil(threshold / (1 + threshold) * (a + b) - 1e-9))


def ways(a: int, b: int, threshold: float, most: int) -> int:
    """Bits of the bands of sets of ``a`` and ``b`` bits: at most ``most``, and few bands for the larger set. Alike for (b, a)."""
    o = common_bits(a, b, threshold)
    n = min(most, o)
    while n > 1 and math.comb(max(a, b) - o + n, n) > MOST:
        n -= 1
    return n


def shapes(a: int, sizes: list[int], threshold: float, most: int) -> list[tuple[int, int, int]]:
    """(pair of sizes, first bits, bits of a band) for every size that a set similar to one of ``a`` bits can have."""
    out = []
    for b in sizes:
        o = common_bits(a, b, threshold)
        if a and b and o <= min(a, b) and min(a, b) >= threshold * max(a, b) - 1e-9:
            n = ways(a, b, threshold, most)
            out.append((min(a, b) << 15 | max(a, b), a - o + n, n))
    return out


def bands_of(ranks: np.ndarray, shapes_: list[tuple[int, int, int]], shift: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs of sizes, bits) of every band of a set, given as ranks from rare to common, and the ``shapes`` of its size."""
    pairs, codes, made = [], [], {}
    for pair, first, n in shapes_:
        if (first, n) not in made:  # alike for all sizes with the same numbers
            code = np.zeros(math.comb(first, n), np.int64)
            for column in choices(first, n):
                code = code << shift | ranks[column] + 1
            made[first, n] = code
        codes.append(made[first, n])
        pairs.append(np.full(len(codes[-1]), pair, np.int32))
    return (np.concatenate(pairs), np.concatenate(codes)) if codes else (np.zeros(0, np.int32), np.zeros(0, np.int64))


def choices(first: int, n: int) -> np.ndarray:
    """The places of every choice of ``n`` of ``first``, a column for each, remembered."""
    if (first, n) not in _CHOICES:
        _CHOICES[first, n] = np.array(list(combinations(range(first), n)), np.int64).reshape(-1, n).T
    return _CHOICES[first, n]


def banded(nodes: DataFrame, key: list[str], threshold: float, bits: str = "fingerprint_bits") -> DataFrame:
    """key, size, w (64-bit words of the set), pairs and codes of its bands, of nodes(key, bits).

    What the driver reads is one count for each bit and one row for each size,
    at most the fingerprint's width of both.
    """
    held = nodes.select(F.explode(bits).alias("bit")).groupBy("bit").agg(F.count("*").alias("n")).collect()
    rank = {r["bit"]: i for i, r in enumerate(sorted(held, key=lambda r: (r["n"], r["bit"])))}
    sizes = sorted(r["s"] for r in nodes.select(F.size(bits).alias("s")).distinct().collect())
    n_words = max(rank, default=0) // 64 + 1
    shift = max(2, (len(rank) + 1).bit_length())
    kinds = dict(nodes.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, list] = {}
        for batch in batches:
            words, pairs, codes = [], [], []
            for some in batch[bits]:
                every = sum(1 << int(b) for b in some)
                at = [(every >> 64 * i) & (2**64 - 1) for i in range(n_words)]
                words.append([x - 2**64 if x >= 2**63 else x for x in at])
                if len(some) not in known:
                    known[len(some)] = shapes(len(some), sizes, threshold, min(WAYS, 60 // shift))
                own = bands_of(np.sort([rank[b] for b in some]), known[len(some)], shift)
                pairs.append(own[0])
                codes.append(own[1])
            yield batch[key].assign(size=[len(x) for x in batch[bits]], w=words, pairs=pairs, codes=codes)

    named = ", ".join(f"`{k}` {kinds[k]}" for k in key)
    return nodes.select(*dict.fromkeys([*key, bits])).mapInPandas(run, f"{named}, size int, w array<long>, pairs array<int>, codes array<long>")


def exploded(rows: DataFrame, *keep: str) -> DataFrame:
    """One row for each band: keep, size, w, pair, code."""
    return rows.select(*keep, "size", "w", F.explode(F.arrays_zip("pairs", "codes")).alias("x")).select(
        *keep, "size", "w", F.col("x.pairs").alias("pair"), F.col("x.codes").alias("code")
    )


def tanimoto(w: Column, v: Column, a: Column, b: Column, n_words: int) -> Column:
    """Similarity of two sets given as words and sizes; two empty sets are equal."""
    common = sum((F.bit_count(w[i].bitwiseAND(v[i])) for i in range(n_words)), F.lit(0))
    union = a + b - common
    return F.when(union == 0, 1.0).otherwise(common / union)


def width(rows: DataFrame) -> int:
    """Words of the sets of ``banded`` rows."""
    first = rows.select(F.size("w").alias("n")).first()
    return first["n"] if first else 1

