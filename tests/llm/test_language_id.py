import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from commentlens.llm import language_id as lid

EN = "the quick brown fox jumps over the lazy dog and then it runs away from the angry bear in the woods".split()
DE = "der schnelle braune fuchs springt über den faulen hund und läuft dann weg vor dem bösen bären".split()


def corpus(n=200, seed=0):
    rng = random.Random(seed)
    return [
        (i, " ".join(rng.choices(EN if i % 2 else DE, k=rng.randrange(3, 40))), "en" if i % 2 else "de") for i in range(n)
    ]


@pytest.fixture(scope="module")
def frame(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)

    return make


def plain_bits(texts, text, order=3):
    """Code length by escaping with exclusion, counted from scratch; rare full contexts are not kept."""
    counts = {}
    for t in texts:
        padded = [None] * order + list(t)
        for i in range(order, len(padded)):
            for k in range(order + 1):
                own = counts.setdefault(tuple(padded[i - k : i]), {})
                own[padded[i]] = own.get(padded[i], 0) + 1
    kept = {c: n for c, n in counts.items() if len(c) < order or sum(n.values()) >= lid.LEAST_SEEN}

    memo = {}

    def probabilities(context):
        if context in memo:
            return memo[context]
        base = np.full(256, 1 / 256) if not context else probabilities(context[1:])
        own = kept.get(context)
        if own is None:
            memo[context] = base
            return base
        seen = np.zeros(256, bool)
        seen[list(own)] = True
        whole, out = sum(own.values()) + len(own), np.zeros(256)
        for s, n in own.items():
            out[s] = n / whole
        out[~seen] = len(own) / whole * base[~seen] / base[~seen].sum()
        memo[context] = out
        return out

    padded = [None] * order + list(text)
    return sum(-math.log2(probabilities(tuple(padded[i - order : i]))[padded[i]]) for i in range(order, len(padded)))


def test_code_lengths_against_brute_force(frame, monkeypatch):
    rows = corpus(60)
    trees = lid.learn(frame(rows))
    assert trees.languages == ["de", "en"]
    texts = ["the fox", "über den", "zzz qqq \x00\x01 日本", "a", " ".join(EN), "The FOX über the hund"]
    got = trees.lengths([t.encode() for t in [*texts, ""]])
    for k, language in enumerate(trees.languages):
        own = [t.encode() for _, t, lang in rows if lang == language]
        for i, text in enumerate(texts):
            assert got[i, k] == pytest.approx(plain_bits(own, text.encode()), rel=2e-4), (text, language)
    assert (got[-1] == 0).all()


def test_probabilities_sum_to_one(frame):
    trees = lid.learn(frame(corpus(60)))
    wide = trees.bits.shape[1]
    unseen = 256 - (wide - 2)
    p = np.exp2(-trees.bits.astype(float))
    total = p[:, 1 : wide - 1].sum(axis=1) + unseen * p[:, wide - 1]
    assert total == pytest.approx(1, abs=1e-3)


def test_held_out_accuracy(frame):
    rows = corpus(400)
    trees = lid.learn(frame(rows[:300]))
    got = lid.predict(frame(rows), trees).collect()
    assert sum(r.lang_pred == r.lang for r in got if r.doc_id >= 300) >= 99
    assert all(0 <= r.score <= 1 for r in got)


def test_prediction_uses_text_alone(frame):
    rows = corpus(100)
    trees = lid.learn(frame(rows))
    plain = {r.doc_id: r.lang_pred for r in lid.predict(frame(rows), trees).collect()}
    other = {r.doc_id - 7: r.lang_pred for r in lid.predict(frame([(i + 7, t, "xx") for i, t, _ in rows]), trees).collect()}
    assert plain == other


def test_odd_texts(frame):
    rows = corpus(100) + [(500, None, "en"), (501, "", "en"), (502, "123 !?", "de"), (503, "ж", None), (504, "fox the " * 60_000, None)]
    docs = frame(rows)
    trees = lid.learn(docs)
    wide = docs.withColumns({"score": F.lit("mine"), "row": F.lit("r"), "letters": F.lit(1)})
    got = {r.doc_id: r for r in lid.predict(wide, trees).collect()}
    assert [got[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3 and got[500].score == 0
    assert got[503].lang_pred in ("de", "en") and got[504].lang_pred == "en" and got[0].row == "r"
    kept = lid.keep_identified(wide, trees)
    assert kept.columns == wide.columns
    assert sorted(r.doc_id for r in kept.collect()) == [*range(100), 503, 504]
    german = lid.keep_identified(wide, trees, accepted=["de"]).collect()
    assert {r.doc_id for r in german} == {i for i in got if got[i].lang_pred == "de"}


def test_nothing_to_learn(frame):
    docs = frame([(1, "some text", None), (2, None, "en")])
    got = lid.predict(docs, lid.learn(docs)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert lid.predict(frame([]), lid.learn(frame([]))).collect() == []


def test_sample_is_bounded_by_keys(frame):
    rows = corpus(60) + [(1000, "the the the", "en")] * 50
    trees = lid.learn(frame(rows), rows=5)
    assert trees.languages == ["de", "en"]
