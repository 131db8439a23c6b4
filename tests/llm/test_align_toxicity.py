"""Cross-tokenizer alignment against whole-text tokenization, and the toxicity classifier on small labelled rows."""

import hashlib
import json
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from alembiq.llm import token_align, toxicity
from alembiq.llm.queries import ALIGNED, tokenizer

A, B = (str(public_tokenizers.path(x)) for x in ALIGNED)
PATTERN = public_tokenizers.PATTERN
ODD = [
    None, "", " ", "\n\n", "x", " lead", "trail ", "a  b", "a\n b \tc", "ß Ünïcödé 漢字 and more", "😀" * 40, "!!! 123 ---", "▁ odd", "it's we'll <|endoftext|> x",
    "<s> </s> <unk> <0x41>", "\x00 a\x1c b", "é x y 　z", "word " * 300, "q" * 5000, "no break here", "½ ﬁ ½ ﬁ", "a .b ,c",
]


def brute(texts):
    """Rows of op11 by whole-text tokenization with both libraries, one byte after the other."""
    a_lib, b_lib = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    to_byte = token_align.byte_of_characters()
    by_id = {i: t for t, i in json.load(open(A))["model"]["vocab"].items()}

    def piece(i):
        p = b_lib.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()

    made, counts = [], Counter()
    for t in texts:
        rows = None
        if t:
            a, b = a_lib.encode(f" {t}", add_special_tokens=False).ids, b_lib.encode(t)
            ba, bb = [bytes(to_byte[c] for c in by_id[i]) for i in a], [piece(i) for i in b]
            if b"".join(ba) == f" {t}".encode() == b"".join(bb):
                ends = lambda parts: np.cumsum([len(x) for x in parts]).tolist()
                at_a, at_b = dict(zip(ends(ba), range(len(a)), strict=True)), dict(zip(ends(bb), range(len(b)), strict=True))
                groups, links, i0, j0 = [], [], 0, 0
                for e in sorted(set(at_a) & set(at_b)):
                    i, j = at_a[e], at_b[e]
                    groups.append(",".join(map(str, a[i0 : i + 1])) + "|" + ",".join(map(str, b[j0 : j + 1])))
                    links.append((a[i], b[j]))
                    i0, j0 = i + 1, j + 1
                rows = (len(a), len(b), groups, links)
                counts.update(links)
        made.append(rows)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for r in made:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links = r
            best = sum(counts[x] == most[x[1]] for x in links)
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            out.append((n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return out


def prose(seed, n):
    rng = random.Random(seed)
    words = "the of and naïve größer ración été token's 12.5 x_y foo-bar (see) end. the,\nnew  line\t".split(" ")
    return " ".join(rng.choice(words) + rng.choice(["", "ing", "s", "!", " "]) for _ in range(n))


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("size", [1 << 21, 300])
def test_alignment_is_that_of_whole_texts(spark, monkeypatch, size):
    monkeypatch.setattr(token_align, "SLICE", size)
    texts = ODD + [prose(i, 150) for i in range(25)] + [prose(3, 150)] * 3
    ids = [None, None, *range(2, len(texts) - 1), 5]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").withColumn("b", F.lit("x")).withColumn("RID", F.lit(1))
    got = token_align.align_tokens(docs.repartition(3), A, B, PATTERN).collect()
    key = lambda i, row: (i is None, i or 0, row)
    want = sorted(key(i, r) for i, r in zip(ids, brute(texts), strict=True))
    assert sorted(key(r.doc_id, tuple(r[f] for f in FIELDS)) for r in got) == want
    for r in got:
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "")


def test_alignment_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_align.align_tokens(none, A, B, PATTERN).count() == 0
    blank = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert {tuple(r[f] for f in FIELDS) for r in token_align.align_tokens(blank, A, B, PATTERN).collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_pair_counts_have_ties(spark):
    docs = spark.createDataFrame([(1, "aa bb"), (2, "aa"), (3, "bb cc")], "doc_id long, text string")
    table = token_align.postings(docs, A, B, PATTERN)
    found = token_align.pair_counts(table).collect()
    assert sum(r.links for r in found) == table.agg(F.sum("n_groups")).first()[0]
    assert all(any(x.best for x in found if x.b == r.b) for r in found)


def test_places_are_safe_in_both_vocabularies():
    a = token_align.aligner(open(A, "rb").read(), open(B, "rb").read(), tokenizer()[1])
    lib = Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    rng = random.Random(5)
    alphabet = [*"ab1.,' \t\n'", "é", " ", " ", "\x85", "\x1f", "漢", "½", "'s", "<|endoftext|>", "́", "  "]
    assert not any("▁" in p[1:] and p.strip("▁") for p in (a.b.id_to_piece(i).lstrip("▁") for i in range(a.b.get_piece_size())))
    for _ in range(400):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40)))
        parts = token_align.PLACE.split(t)
        flat = lambda lists: [x for some in lists for x in some]
        assert flat(a.encode_a([f" {p}" for p in parts])) == lib.encode(f" {t}", add_special_tokens=False).ids
        assert flat(a.b.encode(parts)) == a.b.encode(t)


INSULTS = "blorgo snarfel gritch".split()


def labelled(n=400, seed=1):
    rng = random.Random(seed)
    words = [f"{x}{y}" for x in "tha ond ere lin mor".split() for y in "na te ri so lu ka".split()]
    texts, toxic = [], []
    for i in range(n):
        bad = i % 4 == 0
        some = [rng.choice(words) for _ in range(rng.randrange(20, 120))]
        if bad:
            for _ in range(2):
                some.insert(rng.randrange(len(some)), rng.choice(INSULTS))
        texts.append(" ".join(some))
        toxic.append(int(bad))
    return texts, toxic


def tables(spark, texts, toxic, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("toxic", F.lit(1))
    known = [(i, y, 1 - y) for i, y in zip(ids, toxic, strict=True) if y is not None]
    return docs, spark.createDataFrame(known, "doc_id long, toxic int, quality int")


def test_toxic_texts_are_told_apart(spark):
    texts, toxic = labelled()
    texts += [None, "", "123 ...", f"one {INSULTS[0].upper()} {INSULTS[1]} word", "tha " * 50_000 + f"{INSULTS[0]} {INSULTS[2]}"]
    docs, labels = tables(spark, texts, toxic + [None] * 5)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs.repartition(3), labels).collect()}
    assert len(got) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    held = [(r.predicted, toxic[i]) for i, r in got.items() if r.held_out and i < len(toxic)]
    assert len(held) > 80 and all(p == y for p, y in held)
    n = len(toxic)
    assert [got[n + k].predicted for k in range(5)] == [0, 0, 0, 1, 1]
    again = {r.doc_id: r.score for r in toxicity.score_toxicity(docs.repartition(7), labels).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_held_out_labels_are_not_read(spark):
    texts, toxic = labelled(120)
    docs, labels = tables(spark, texts, toxic)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(3, 1), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    both = [{r.doc_id: r.score for r in toxicity.score_toxicity(docs, x).collect()} for x in (labels, turned)]
    assert both[0] == both[1]


def test_counterfactuals_spare_neutral_mentions():
    """All toxic texts mention a group, others don't: without the penalty the mention alone is evidence."""
    texts, toxic = labelled(300)
    rows = []
    for k, (t, y) in enumerate(zip(texts, toxic, strict=True)):
        words = toxicity.words_of(t) | ({"refugees"} if y and k % 8 else set())
        gone, new = toxicity.swap(words, k, toxicity.IDENTITY)
        assert bool(gone) == ("refugees" in words) and len(new) == 1
        at, c = toxicity.tally(words)
        change = {}
        for some, sign in ((gone, -1), (new, 1)):
            for b, n in zip(*toxicity.tally(some), strict=True):
                change[b] = change.get(b, 0) + sign * n
        rows.append((y, at, c, np.array(sorted(change), np.int64), np.array([float(change[b]) for b in sorted(change)])))
    plain, fair = (toxicity.train(rows, 0.25, penalty=p).scorer() for p in (0, 1.0))
    clean = [f"{t} refugees" for t, y in zip(texts, toxic, strict=True) if not y]
    assert sum(plain(t) >= 0.7 for t in clean) > len(clean) / 2
    assert sum(fair(t) >= 0.7 for t in clean) == 0
    assert all(fair(f"tha ond {x} {y}") >= 0.7 for x in INSULTS for y in INSULTS if x != y)


def brute_score(model, text):
    z = model.bias
    for w in {w.lower() for w in toxicity.WORD.findall(text)}:
        z += sum(model.weights[b] for b in toxicity.hashed(w))
    return 1 / (1 + math.exp(-z))


def test_scores_are_those_of_brute_force_and_few_labels_do(spark):
    texts, toxic = labelled(60)
    docs, labels = tables(spark, texts, toxic)
    model = toxicity.fit(docs, labels, sample_rows=40)
    score = model.scorer()
    assert all(math.isclose(score(t), brute_score(model, t), rel_tol=1e-9) for t in texts)
    one = toxicity.fit(docs, labels.filter("toxic = 0"))
    assert not one.weights.any() and one.scorer()("x") < 0.1
    none = labels.limit(0)
    rows = toxicity.score_toxicity(docs, none).collect()
    assert {(r.score, r.predicted) for r in rows} == {(0.5, 0)}
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_sample_is_bounded_and_doubled_labels_are_one(spark):
    rows = [(i % 50, int(i % 5 == 0 and i < 50)) for i in range(100)] + [(None, 1), (7, None), (8, 3)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    some, prior = toxicity.sampled(labels, 16)
    got = some.collect()
    assert len(got) == 16 and Counter(r.toxic for r in got) == {0: 8, 1: 8} and abs(prior - 0.2) < 0.02
    ids = [None, 3, 3]
    docs = spark.createDataFrame([(i, "blorgo here") for i in ids], "doc_id long, text string")
    assert len({r.score for r in toxicity.score_toxicity(docs, labels).collect()}) == 1
