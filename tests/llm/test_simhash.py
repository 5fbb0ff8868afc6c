import random

import numpy as np
import pytest
import xxhash

from commentlens.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=2):
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("text", ["", "one", "One two", "A b C d e f g a b c", "x " * 200, "été   Éa\x0bb\x1cc D"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("first", [0, 3, 8])
def test_search_is_exact(first):
    rng = random.Random(first)
    base = [rng.getrandbits(64) for _ in range(60)]
    near = [b ^ sum(1 << k for k in rng.sample(range(64), rng.choice([1, 2, 3]))) for b in base for _ in range(6)]
    fps = np.array(sorted(set(base + near)), dtype=np.uint64).view(np.int64)
    zero = np.zeros(len(fps), np.int64)
    a, b = simhash.search(fps, fps, zero, zero == 0, simhash.choose_vantage(fps.tolist()), first, 2)
    got = sorted(zip(a.tolist(), b.tolist()))
    want = sorted(
        (int(x), int(y)) for x in fps for y in fps if x < y and int(np.bitwise_count(x ^ y)) <= 2
    )
    assert got == want


def test_moves_share_one_budget():
    assert len(simhash.offsets(8, 2)) == 1 + 16 + 16 + 4 * 28


def mutated(rng, words):
    words = list(words)
    words[rng.randrange(len(words))] = f"new{rng.random()}"
    return words


@pytest.mark.parametrize("block", [100_000, 7])
def test_near_copies_against_brute_force(spark, make_docs, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(3)
    rows = [(0, None), (1, ""), (2, " \n"), (3, "short"), (4, "Short"), (5, "two words"), (6, "x " * 20000)]
    for family in range(12):
        words = [f"w{rng.randrange(500)}" for _ in range(300)]
        for _ in range(8):
            rows.append((len(rows), " ".join(words)))
            words = mutated(rng, words) if rng.random() < 0.7 else words
    rng.shuffle(rows)
    got = {r.key: (r.fp, r.component) for r in simhash.near_copies(make_docs(rows)).collect()}
    prints = {k: plain_fingerprint(t) for k, t in rows}
    want = plain_components(prints)
    assert {k: v[0] % 2**64 for k, v in got.items()} == prints
    assert {k: v[1] for k, v in got.items()} == want
    assert len(set(want.values())) < len(rows) - 20
    kept = simhash.drop_near_copies(make_docs(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_nulls_repeats_and_empty(make_docs):
    rows = [(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (9, "A b c d"), (None, "other words entirely here now")]
    got = sorted((str(r.key), str(r.component)) for r in simhash.near_copies(make_docs(rows)).collect())
    assert got == [("7", "7"), ("7", "7"), ("9", "7"), ("None", "7"), ("None", "None")]
    kept = simhash.drop_near_copies(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == [("7", "a b c d"), ("None", "other words entirely here now")]
    assert simhash.near_copies(make_docs([])).collect() == []
    assert simhash.drop_near_copies(make_docs([])).collect() == []
