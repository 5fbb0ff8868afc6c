import collections
import math
import random
import zlib

import numpy as np
import pytest

from commentlens.llm import hashed_maxent as lm


def words_of(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def corpus(n=240, seed=4):
    """Texts in two made-up languages: words follow their language's, so histories tell much."""
    rng = random.Random(seed)
    lists = [[f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]]
    rows = []
    for i in range(n):
        own = rng.choice(lists)
        words = [own[min(int(rng.expovariate(0.1)), 59)] for _ in range(rng.randrange(5, 60))]
        if rng.random() < 0.2:
            words.append(f"rare{rng.randrange(400)}")
        rows.append((i, " ".join(words)))
    return rows + [(n, None), (n + 1, ""), (n + 2, "Unseen WORDS only \x0b here"), (n + 3, "a1 " * 30_000)]


def plain_base(rows, train_rows):
    counts = collections.Counter(w for _, t in train_rows for w in words_of(t))
    total, distinct = sum(counts.values()), len(counts)
    out = {}
    for key, text in rows:
        words = words_of(text)
        score = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        out[key] = (len(words), sum(counts[w] > 0 for w in words), total, score)
    return out


@pytest.mark.parametrize("vocabulary", [131_072, 40])
def test_counts_and_base_against_brute_force(make_docs, monkeypatch, vocabulary):
    monkeypatch.setattr(lm, "VOCABULARY", vocabulary)
    rows = corpus()
    train_rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    trained = lm.train(make_docs(train_rows))
    assert len(trained.model.known) <= vocabulary and (vocabulary > 1000 or trained.other_words > 0)
    got = {r.key: r for r in lm.score(make_docs(rows), trained).collect()}
    want = plain_base(rows, train_rows)
    assert got.keys() == want.keys()
    for key, (n, known, total, base) in want.items():
        r = got[key]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0
    held = [k for k in want if zlib.crc32(str(k).encode()) % 7 == 2 and want[k][0] > 5]
    assert sum(got[k].score for k in held) > sum(got[k].base_score for k in held)


def test_score_is_the_model_by_hand(make_docs):
    rows = corpus(60)
    trained = lm.train(make_docs(rows))
    m = trained.model
    got = {r.key: r.score for r in lm.score(make_docs(rows), trained).collect()}
    for key, text in rows[:20] + rows[-4:-1]:
        ranks = [m.known.get(w, m.other) for w in words_of(text)]
        total = 0.0
        for i, rank in enumerate(ranks):
            features = lm.histories(np.array(ranks[: i + 1]), np.array([i + 1]), m.other)
            logits = m.bias.astype(float) + sum(m.weights[f[i]].astype(float) for f in features)
            p = np.exp(logits - logits.max())
            total += math.log10(p[m.class_of[rank]] / p.sum()) + m.share[rank]
            if rank == m.other:
                total += math.log10(1 / (trained.other_tokens + trained.other_words + 1))
        assert got[key] == pytest.approx(total, rel=1e-4, abs=1e-4)


def test_probabilities_sum_to_one():
    model = lm.start([b"x", b"y", b"\n"], np.array([50, 30, 20]), 7)
    model.weights[:] = np.random.default_rng(0).normal(size=model.weights.shape)
    features = lm.histories(np.array([0, 1, 3]), np.array([3]), model.other)
    shares = np.exp(lm.log_shares(model.weights, model.bias, features)).astype(float)
    assert shares.sum(axis=1) == pytest.approx(1, abs=1e-5)
    by_class = collections.Counter()
    for rank in range(3):
        by_class[int(model.class_of[rank])] += 10 ** model.share[rank]
    assert all(v == pytest.approx(1) for v in by_class.values())


def test_histories_stay_in_their_text():
    ranks = np.array([4, 5, 6, 4, 5, 6, 7])
    one = lm.histories(ranks, np.array([3, 3, 1]), 9)
    assert all((f[:3] == f[3:6]).all() and f[0] == f[6] for f in one)


def test_repeats_nulls_and_empty(make_docs):
    docs = make_docs([(1, "same words"), (1, "same words"), (None, "same words"), (2, None)])
    rows = lm.score(docs, lm.train(docs)).collect()
    assert len(rows) == 4 and len({r.score for r in rows if r.n_tokens == 3}) == 1
    empty = lm.train(make_docs([]))
    assert lm.score(make_docs([]), empty).collect() == []
    r = lm.score(make_docs([(1, "a b")]), empty).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)
