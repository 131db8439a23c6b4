"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its hashed character n-grams; one
linear layer with a softmax reads it. Embeddings and layer are trained together
by stochastic gradient descent in numpy on a bounded sample of labelled rows
(``sample_rows``), the same number of each label. The products embedding x layer
are folded into one small matrix (buckets x classes), the only thing that is
broadcast; its size is fixed by the parameters.

Rejection needs texts that ought to be rejected. Each sampled text also gives a
fragment with its label and a counterexample without one: a fragment whose
alphabet is permuted, vowels among vowels (the letters of a language that nobody
has seen), whose letters are shuffled, or drawn at random. Counterexamples train
one more class, which is never predicted. Beside the score stands the *fit*, the
mean log frequency of the text's n-grams in the predicted language, which is low
for a text whose n-grams it hardly knows, however sure the softmax is. A fifth of
the sampled rows only calibrates: they set the softmax temperature and, for four
ranges of length, the score and the fit below which a prediction is rejected.
Each costs least on them, where a right text rejected counts ``KEEP`` times a
counterexample accepted.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import free_name, share, shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 14
ORDERS = (1, 2, 3, 4)
CHUNK = 1 << 18
UND = "und"
KEEP = 100
#: Letters from which on a text is in the next range of length.
LENGTHS = (16, 64, 256)
MAX_LABELS = 512
VOWELS = "aeiouyàáâãäåæèéêëìíîïòóôõöøùúûüýœ"
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def features(text: str | None) -> tuple[np.ndarray, int]:
    """Counts of hashed n-grams (2**BITS buckets) over the whole text, and its number of letters.

    Letters are lower-cased; every run of other characters becomes one space.
    """
    counts = np.zeros(1 << BITS, dtype=np.int64)
    text = text or ""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    is_letter = _letters()[codes]
    n_letters = int(is_letter.sum())
    if not n_letters:
        return counts, 0
    codes = np.where(is_letter, codes, 32)
    gap = codes == 32
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    codes = np.concatenate(([32], codes[keep], [32])).astype(np.uint32)
    for start in range(0, len(codes), CHUNK):
        h = np.zeros(len(codes[start : start + CHUNK]), dtype=np.uint32)
        for k in ORDERS:
            nxt = codes[start + k - 1 : start + k - 1 + CHUNK]
            h = h[: len(nxt)] * np.uint32(0x01000193) + nxt
            slot = ((h + np.uint32(k)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
            counts += np.bincount(slot, minlength=1 << BITS)
    return counts, n_letters


def fragment(text: str, rng: np.random.Generator, lengths: tuple[int, ...]) -> str:
    """Some words of a text, about as many characters as one of ``lengths``."""
    size = int(rng.choice(lengths))
    start = int(rng.integers(0, max(1, len(text) - size)))
    while start and not text[start - 1].isspace() and start < len(text) - 1:
        start += 1
    return text[start : start + size]


def counterexample(text: str, rng: np.random.Generator) -> str:
    """A fragment in the same letters that is no text of the language."""
    text = fragment(text, rng, (24, 80, 300, 600)).lower()
    letters = [c for c in text if c.isalpha()]
    kind = rng.random()
    if kind < 0.6:
        table: dict[str, str] = {}
        for group in (sorted({c for c in letters if c in VOWELS}), sorted({c for c in letters if c not in VOWELS})):
            table |= dict(zip(group, rng.permutation(group).tolist(), strict=True)) if group else {}
        return "".join(table.get(c, c) for c in text)
    alphabet = letters if kind < 0.8 else sorted(set(letters))
    drawn = iter(rng.permutation(letters).tolist() if kind < 0.8 else rng.choice(alphabet, len(letters)).tolist() if letters else [])
    return "".join(next(drawn) if c.isalpha() else c for c in text)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # buckets x (languages and the class of counterexamples): embeddings times layer, float32
    bias: np.ndarray
    known: np.ndarray  # buckets x languages: log frequency, float32
    temperature: float = 1.0
    reject_below: list[tuple[float, float]] = field(default_factory=lambda: [(0.0, -np.inf)] * (len(LENGTHS) + 1))

    def scores(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(calibrated probabilities of one text's n-gram counts, the last one that of no known language; fit to each language)."""
        at = np.flatnonzero(counts)
        x = counts[at].astype(np.float32)
        x /= x.sum()
        logits = (x @ self.table[at] + self.bias) / self.temperature
        e = np.exp(logits - logits.max())
        return e / e.sum(), x @ self.known[at]

    def judge(self, counts: np.ndarray, n_letters: int) -> tuple[str, float, bool]:
        """(likeliest language, its probability, whether that is rejected)."""
        p, fits = self.scores(counts)
        i = int(p[:-1].argmax())
        least, least_fit = self.reject_below[sum(n_letters >= x for x in LENGTHS)]
        return self.languages[i], float(min(1.0, p[i])), bool(p[i] < least or fits[i] < least_fit)


def least_cost(right: np.ndarray, wrong: np.ndarray) -> float:
    """The threshold that costs least: ``KEEP`` for a right text's score below it, 1 for a wrong one's from it on; the middle of equals."""
    if not len(right) or not len(wrong):
        return -np.inf
    at = np.unique(np.concatenate((right, wrong)))
    cost = KEEP * np.searchsorted(np.sort(right), at) / len(right) + (len(wrong) - np.searchsorted(np.sort(wrong), at)) / len(wrong)
    best = int(cost.argmin())
    below = at[best - 1] if best else at[best]
    # Less what rounding may take from a score on another way of summing.
    return float(min((below + at[best]) / 2, at[best] - 1e-6))


Row = tuple[np.ndarray, np.ndarray, str | None, int]


def train(rows: list[list[Row]], dims: int = 16, epochs: int = 6, rate: float = 8.0, seed: int = 7) -> Model:
    """rows: of each sampled text its own (buckets, counts, language, letters) and those made of it; language None is a counterexample.

    Every fifth text of a language calibrates with all that is made of it, the
    others train.
    """
    languages = sorted({r[2] for text in rows for r in text if r[2] is not None})
    label = {x: i for i, x in enumerate([*languages, None])}
    fit, held, seen = [], [], dict.fromkeys(label, 0)
    met = np.full((1 << BITS, len(languages)), 0.5)
    for text in rows:
        made = [(at, (c / c.sum()).astype(np.float32), label[y], n) for at, c, y, n in text]
        if seen[text[0][2]] % 5:
            fit.extend(made)
            met[text[0][0], label[text[0][2]]] += text[0][1]
        else:
            held.extend(made)
        seen[text[0][2]] += 1
    fit = fit or held
    rng = np.random.default_rng(seed)
    width = len(label)
    emb = rng.uniform(-1 / dims, 1 / dims, (1 << BITS, dims)).astype(np.float32)
    layer, bias = np.zeros((dims, width), np.float32), np.zeros(width, np.float32)
    steps, step = epochs * len(fit), 0
    for _ in range(epochs):
        for i in rng.permutation(len(fit)):
            at, x, y, _ = fit[i]
            lr = rate * (1 - step / steps)
            step += 1
            own = emb[at]
            h = x @ own
            z = h @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = layer @ p
            layer -= (0.05 * lr) * np.outer(h, p)
            bias -= (0.001 * lr) * p
            emb[at] = own - lr * np.outer(x, back)
    model = Model(languages, emb @ layer, bias, np.log(met / met.sum(axis=0)).astype(np.float32))
    z = np.array([x @ model.table[at] + bias for at, x, _, _ in held])
    z -= z.max(axis=1, keepdims=True)
    y = np.array([r[2] for r in held])

    def loss(t):
        s = z / t
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]))

    model.temperature = min((0.1, 0.18, 0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    p = np.exp(z / model.temperature)
    p /= p.sum(axis=1, keepdims=True)
    best = p[:, :-1].argmax(axis=1)
    fits = np.array([x @ model.known[at, i] for (at, x, _, _), i in zip(held, best, strict=True)])
    length = np.array([sum(r[3] >= x for x in LENGTHS) for r in held])
    wrong = y == width - 1
    for k in range(len(LENGTHS) + 1):
        model.reject_below[k] = tuple(least_cost(v[~wrong & (length == k)], v[wrong & (length == k)]) for v in (p[:, :-1].max(axis=1), fits))
    return model


def sample(labelled: DataFrame, sample_rows: int) -> DataFrame:
    """(lang, text): distinct labelled(doc_id, text, lang) rows, up to ``sample_rows`` over all labels and as many of each, those of the least hash of id and text.

    Rows are thinned by that hash to about three times a label's share before
    any are brought together; a label with few rows gives them all. The
    ``MAX_LABELS`` commonest labels are learned.
    """
    rows = labelled.filter("text is not null and lang is not null").select("lang", "text", F.xxhash64("doc_id", "text", F.lit("langid")).alias("h"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LABELS).collect()
    share_ = max(1, sample_rows // max(1, len(sizes)))
    bounds = [(r["lang"], int(min(2**63 - 1, -(2**63) + 2**64 * (3 * share_ + 20) / r["n"]))) for r in sizes]
    kept = rows.join(F.broadcast(labelled.sparkSession.createDataFrame(bounds, "lang string, bound long")), "lang").filter("h <= bound")
    once = kept.groupBy("lang", "h").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return once.withColumn("place", place).filter(F.col("place") <= share_).select("lang", "text")


def fit(labelled: DataFrame, sample_rows: int = 2000) -> Model:
    """Train on the ``sample`` of labelled(doc_id, text, lang).

    Rows without letters or label don't count; whole texts do. What reaches the
    driver is at most ``sample_rows`` times three times 2**BITS counts. With no
    labelled row the model knows no language.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                rng = np.random.default_rng(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")))
                made = [(text, lang), (fragment(text, rng, (8, 24, 80, 300)), lang), (counterexample(text, rng), None)]
                for part, (own, label) in enumerate(made):
                    counts, letters = features(own)
                    if not letters:
                        if part:
                            continue
                        break
                    at = np.flatnonzero(counts).astype("<i4")
                    out.append((part, at.tobytes(), counts[at].astype("<i8").tobytes(), label, letters))
            yield pd.DataFrame(out, columns=["part", "at", "counts", "lang", "letters"])

    made = sample(labelled, sample_rows).mapInPandas(run, "part int, at binary, counts binary, lang string, letters long")
    texts: list[list[Row]] = []
    for r in made.collect():
        if r["part"] == 0:
            texts.append([])
        texts[-1].append((np.frombuffer(r["at"], "<i4"), np.frombuffer(r["counts"], "<i8"), r["lang"], r["letters"]))
    if not texts:
        return Model([], np.zeros((1 << BITS, 1), np.float32), np.zeros(1, np.float32), np.zeros((1 << BITS, 0), np.float32))
    # in an order that no partitioning changes, so that the same rows give the same model
    return train(sorted(texts, key=lambda t: (t[0][2], t[0][3], t[0][0].tobytes(), t[0][1].tobytes())))


def predict(text: Column, model: Model, spark) -> Column:
    """struct(lang, score, rejected) of each whole text.

    ``und`` with score 0, rejected, if the text is null or has no letter, or if
    the model knows no language. Otherwise the likeliest language with its
    calibrated probability; rejected says that this or the fit is below the threshold.
    """
    held = share(spark, model)

    def run(texts: pd.Series) -> pd.DataFrame:
        own, out = shared(Model, held), []
        for text in texts:
            counts, letters = features(text)
            if not letters or not own.languages:
                out.append((UND, 0.0, True))
                continue
            out.append(own.judge(counts, letters))
        return pd.DataFrame(out, columns=["lang", "score", "rejected"])

    return F.pandas_udf(run, "lang string, score double, rejected boolean")(text)


def held_out(folds: int, fold: int, id_col: str = "doc_id") -> Column:
    """Whether crc32(id as text) mod ``folds`` is ``fold``; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, sample_rows: int = 2000) -> DataFrame:
    """Predict the language of every row of docs(doc_id, text, lang) from its text alone.

    Learns from rows outside fold 0 of 5. Returns one row per row: doc_id,
    held_out, lang_pred, score, rejected. Null and letterless texts are ``und``. Repeated
    rows are predicted alike; extra columns are not read; an empty table gives
    no rows.
    """
    base = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = fit(base.filter(~held_out(5, 0)), sample_rows)
    seen = base.select("doc_id", held_out(5, 0).alias("held_out"), predict(F.col("text"), model, docs.sparkSession).alias("p"))
    return seen.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.rejected").alias("rejected"))


def keep_identified(docs: DataFrame, sample_rows: int = 2000) -> DataFrame:
    """``docs`` without the rows whose language is rejected, with all its columns."""
    base = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = fit(base.filter(~held_out(5, 0)), sample_rows)
    name = free_name(docs, "lang")
    return docs.withColumn(name, predict(F.col("text").cast("string"), model, docs.sparkSession)).filter(~F.col(f"`{name}`.rejected")).drop(name)
