"""Toxicity: a linear classifier of words and their beginnings, regularised by counterfactuals.

A labelled text and its copy with identity terms swapped should score alike. In
training the squared difference of the two scores is a penalty, so that the
mention of a group, or the beginnings it shares with an insult, earns no
weight. A text without identity terms meets one that is put in.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .langid import held_out
from .util import share, shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = re.compile(r"[^\W\d_]+")
BITS = 18
#: Lengths of the beginnings of a word that are features beside the word itself.
BEGINNINGS = (3, 4, 5, 6, 8)
#: Words remembered by a worker, and the length beyond which a word isn't.
KEPT, KEPT_CHARS = 200_000, 64

# Terms that name groups of people, by kind; terms of a kind are swapped for each other.
IDENTITY: dict[str, tuple[str, ...]] = {
    "religion": (
        "muslim", "muslims", "christian", "christians", "jewish", "jew", "jews", "hindu", "hindus", "buddhist", "atheist", "catholic",
        "muslime", "christen", "juden", "musulmanes", "cristianos", "judíos", "musulmans", "chrétiens", "juifs",
    ),
    "origin": (
        "black", "white", "asian", "african", "latino", "arab", "european", "american", "immigrant", "immigrants", "refugee", "refugees", "foreigners",
        "migranten", "flüchtlinge", "ausländer", "inmigrantes", "refugiados", "extranjeros", "immigrés", "réfugiés", "étrangers",
    ),
    "gender": (
        "woman", "women", "man", "men", "female", "male", "girls", "boys", "transgender", "trans",
        "frauen", "männer", "mujeres", "hombres", "femmes", "hommes",
    ),
    "orientation": ("gay", "lesbian", "bisexual", "straight", "queer", "homosexual", "heterosexual", "schwule", "lesben", "lesbianas", "lesbiennes"),
    "condition": ("disabled", "blind", "deaf", "autistic", "old", "young", "elderly", "poor", "behinderte", "alte", "discapacitados", "ancianos", "handicapés"),
}


def hashed(word: str) -> list[int]:
    """The buckets of a word: its own and those of its beginnings."""
    keys = [f"{word}$", *[word[:k] for k in BEGINNINGS if len(word) > k]]
    return [xxhash.xxh32_intdigest(k) & ((1 << BITS) - 1) for k in keys]


def words_of(text: str | None) -> set[str]:
    """The distinct words of a whole text in lower case."""
    return set(WORD.findall((text or "").lower()))


def tally(words) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, how many of the words have each)."""
    every = [b for w in words for b in hashed(w)]
    at, n = np.unique(np.array(every, np.int64), return_counts=True)
    return at, n


def swap(words: set[str], seed: int, terms: dict[str, tuple[str, ...]]) -> tuple[set[str], set[str]]:
    """(terms that leave, terms that come) for a counterfactual text; one comes alone where the text has none."""
    kinds = list(terms)
    gone, new = set(), set()
    for kind in kinds:
        own = [t for t in terms[kind] if t in words]
        free = [t for t in terms[kind] if t not in words]
        if own and free:
            gone.update(own)
            new.update(free[(seed + i) % len(free)] for i in range(len(own)))
    if not gone:
        every = [t for kind in kinds for t in terms[kind] if t not in words]
        new = {every[seed % len(every)]} if every else set()
    return gone, new


class Model:
    """A weight for each bucket and a bias; a word's weight is the sum of its buckets'."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def scorer(self):
        """Score of a whole text: the logistic function of the bias and the weights of its distinct words."""
        weights, known = self.weights, {}

        def of(word: str) -> float:
            got = known.get(word)
            if got is None:
                got = float(weights[hashed(word)].sum())
                if len(word) <= KEPT_CHARS:
                    if len(known) >= KEPT:
                        known.clear()
                    known[word] = got
            return got

        def score(text: str | None) -> float:
            # in sorted order, so that no set's order changes the sum's last bits
            z = self.bias + sum(map(of, sorted(words_of(text))))
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return score


Row = tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def train(rows: list[Row], prior: float, penalty: float = 1.0, epochs: int = 8, rate: float = 0.3, decay: float = 1e-3, least: int = 3, seed: int = 7) -> Model:
    """rows: (label, buckets and counts of a text, buckets and change of counts of its counterfactual).

    A bucket counts by its log ratio between the labels, none if fewer than
    ``least`` texts have it. Each step lowers the text's log loss, ``penalty``
    times the squared change of the counterfactual's score, and ``decay``.
    ``prior`` is the share of label 1 among all labelled rows; the bias is
    moved from the sample's share to it.
    """
    df = np.zeros((2, 1 << BITS))
    for y, at, _, _, _ in rows:
        df[y, at] += 1
    n = np.array([sum(r[0] == y for r in rows) for y in (0, 1)])
    share_ = (n[1] + 0.5) / (n.sum() + 1)
    shift = np.log(prior / (1 - prior)) - np.log(share_ / (1 - share_))
    if not n.all():  # nothing to tell apart
        return Model(np.zeros(1 << BITS), float(np.log(prior / (1 - prior))))
    ratio = np.log((df[1] + 1) / (n[1] + 2)) - np.log((df[0] + 1) / (n[0] + 2))
    ratio[df.sum(axis=0) < least] = 0
    w, seen, bias, seen_bias = np.zeros(1 << BITS), np.full(1 << BITS, 0.01), 0.0, 1.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            y, at, c, other, change = rows[k]
            x = c * ratio[at]
            z = bias + x @ w[at]
            miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
            step = miss * x + decay * w[at]
            seen[at] += step * step
            w[at] -= rate * step / np.sqrt(seen[at])
            seen_bias += miss * miss
            bias -= rate * miss / np.sqrt(seen_bias)
            if penalty and len(other):
                d = change * ratio[other]
                size = d @ d
                if size > 0:  # the exact step towards the least of the penalty and the distance to the weights
                    w[other] -= (penalty / (1 + penalty * size)) * (d @ w[other]) * d
    return Model(w * ratio, float(bias + shift))


def sampled(labels: DataFrame, sample_rows: int) -> tuple[DataFrame, float]:
    """((doc_id, toxic) of at most ``sample_rows`` rows, half for each label, those of the least hash of id; the share of label 1).

    A document that has both labels is toxic. Ids are thinned by their hash
    before any are ranked.
    """
    one = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    h = F.xxhash64("doc_id", F.lit("toxicity"))
    sizes = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share_ = sample_rows // 2
    bound = F.lit(None).cast("long")
    for y, n in sizes.items():
        bound = F.when(F.col("toxic") == y, F.lit(int(min(2**63 - 1, -(2**63) + 2**64 * (2 * share_ + 20) / n)))).otherwise(bound)
    kept = one.withColumn("h", h).filter(F.col("h") <= bound)
    place = F.row_number().over(Window.partitionBy("toxic").orderBy("h", "doc_id"))
    some = kept.withColumn("place", place).filter(F.col("place") <= share_).select("doc_id", "toxic")
    return some, (sizes.get(1, 0) + 0.5) / (sum(sizes.values()) + 1)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 6000, penalty: float = 1.0, terms: dict[str, tuple[str, ...]] = IDENTITY) -> Model:
    """Train on whole texts of docs(doc_id, text) that labels(doc_id, toxic) mark, ``sample_rows`` at most.

    The sampled ids are broadcast (their number is the parameter), so that no
    text is shuffled to find its label. What reaches the driver is the distinct
    buckets of each sampled text. With one label only, or none, every text gets
    the labels' share of 1.
    """
    some, prior = sampled(labels, sample_rows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, y, text in zip(batch["doc_id"], batch["toxic"], batch["text"], strict=True):
                words = words_of(text)
                gone, new = swap(words, zlib.crc32((text or "").encode("utf-8", "surrogatepass")), terms)
                at, c = tally(words)
                (a, m), (b, n) = tally(gone), tally(new)
                other, back = np.unique(np.r_[a, b], return_inverse=True)
                change = np.zeros(len(other))
                np.add.at(change, back, np.r_[-m, n])
                out.append((doc_id, y, at.astype("<i4").tobytes(), c.astype("<i4").tobytes(), other.astype("<i4").tobytes(), change.astype("<f8").tobytes()))
            yield pd.DataFrame(out, columns=["doc_id", "toxic", "at", "c", "other", "change"])

    met = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(some), "doc_id")
    made = met.mapInPandas(run, "doc_id long, toxic int, at binary, c binary, other binary, change binary").collect()
    # in an order that no partitioning changes, so that the same rows give the same model
    made = sorted({tuple(r) for r in made})
    kinds = ("<i4", "<i4", "<i4", "<f8")
    return train([(r[1], *[np.frombuffer(x, k) for x, k in zip(r[2:], kinds, strict=True)]) for r in made], prior, penalty)


def predict(text: Column, model: Model, spark) -> Column:
    """The score of each whole text."""
    held = share(spark, model)

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = shared(Model, held).scorer()
        for some in texts:
            yield pd.Series([score(t) for t in some], dtype="float64")

    return run(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = 6000, threshold: float = 0.7, penalty: float = 1.0) -> DataFrame:
    """Score every whole text of docs(doc_id, text) for toxicity.

    Labels are learned only from rows outside fold 1 of 3; a score depends on
    the text alone. Returns one row per row of ``docs``: doc_id, held_out,
    score (0 to 1, higher: label 1 likelier), predicted (1 from ``threshold``
    on). A null, empty or wordless text gets the score of no words. A null id
    is in no fold and has no label; repeated rows are scored alike; other
    columns are not read; an empty table gives no rows.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter(~held_out(3, 1))
    model = fit(docs, known, sample_rows, penalty)
    score = predict(F.col("text").cast("string"), model, docs.sparkSession)
    seen = docs.select("doc_id", held_out(3, 1).alias("held_out"), score.alias("score"))
    return seen.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
