import random

import pytest

import corpus_pipeline
from commentlens.llm import simhash, word_overlap
from tests.conftest import SF


def shingle_set(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b)


def changed(rng, words, times):
    words = list(words)
    for i in rng.sample(range(len(words)), times):
        words[i] = f"new{rng.randrange(10**9)}"
    return words


@pytest.fixture(scope="module")
def texts():
    """Random texts, each with a near copy, a similar text and a hardly similar one; and a large group of near copies."""
    rng = random.Random(3)
    out = []
    for size in [60, 100, 200, 400] * 8:
        base = [f"w{rng.randrange(5000)}" for _ in range(size)]
        out += [base, changed(rng, base, 1), changed(rng, base, size // 50), changed(rng, base, size // 12)]
    base = [f"h{rng.randrange(5000)}" for _ in range(150)]
    out += [changed(rng, base, 1) for _ in range(60)]
    return [" ".join(x) for x in out] + ["short text", "Short  TEXT", "other text"]


def test_stage_leaves_no_similar_pair(spark, make_docs, texts):
    rows = list(enumerate(texts))
    missed = [
        (i, j) for i in range(0, 128, 4) for j in (i + 1, i + 2)
        if jaccard(texts[i], texts[j]) >= 0.8
        and bin(simhash.fingerprint(texts[i].encode()) ^ simhash.fingerprint(texts[j].encode())).count("1") > 2
    ]
    assert len(missed) > 20  # the rule of 2 bits alone leaves them
    stage = dict(corpus_pipeline.STAGES)["simhash_dedup"]
    got = stage(spark, make_docs(rows, 5), SF)
    kept = sorted(r.doc_id for r in got.collect())
    assert not [(a, b) for n, a in enumerate(kept) for b in kept[n + 1 :] if jaccard(texts[a], texts[b]) >= 0.8]
    for gone in set(range(len(texts))) - set(kept):
        assert any(jaccard(texts[gone], texts[i]) >= 0.8 for i in range(gone))


def test_only_similar_rows_go(make_docs):
    docs = make_docs([(1, None), (2, ""), (None, "same words here"), (None, "same words here"), (3, "same words here"), (4, "Same words  here"), (5, "x")])
    got = sorted((r.doc_id or 0, r.text) for r in word_overlap.drop_similar(docs).collect())
    assert [k for k, _ in got] == [0, 0, 1, 2, 3, 5]
    assert word_overlap.drop_similar(make_docs([])).collect() == []


def kept_ids(docs):
    return sorted(r.doc_id for r in word_overlap.drop_similar(docs).collect())


def test_similarity_of_hashes():
    rng = random.Random(1)
    for _ in range(50):
        a = [f"w{rng.randrange(30)}" for _ in range(rng.randrange(40))]
        b = changed(rng, a, len(a) // 10)
        found = word_overlap.similarity(*(word_overlap.shingle_hashes(" ".join(x).encode(), 5) for x in (a, b)))
        assert found == (pytest.approx(jaccard(" ".join(a), " ".join(b))) if a and b else 0.0)


def test_boilerplate_drops_nothing(make_docs):
    rng = random.Random(6)
    shared = " ".join(f"licence{i}" for i in range(120))
    rows = [(i, shared + " " + " ".join(f"t{rng.randrange(10**6)}" for _ in range(90))) for i in range(40)]
    assert kept_ids(make_docs(rows)) == list(range(40))


@pytest.mark.parametrize("copies", [0, 3, 220])
def test_what_stays_does_not_depend_on_the_size_of_a_group(make_docs, copies):
    """3 is similar to 2 alone, which is similar to 1."""
    rng = random.Random(8)
    first = [f"c{rng.randrange(10**6)}" for _ in range(300)]
    second = [*first[:12], "new", *first[13:40], "more", *first[41:70], "words", *first[71:]]
    third = [*second[:150], *(f"x{i}" for i in range(14)), *second[164:]]
    rows = [(i + 1, " ".join(t)) for i, t in enumerate((first, second, third))]
    assert jaccard(rows[0][1], rows[1][1]) >= 0.8 and jaccard(rows[1][1], rows[2][1]) >= 0.8 > jaccard(rows[0][1], rows[2][1])
    rows += [(100 + i, " ".join(changed(rng, second, 1))) for i in range(copies)]
    assert kept_ids(make_docs(rows, 5)) == [1]


def test_blocks_of_a_large_band(make_docs, monkeypatch):
    monkeypatch.setattr(word_overlap, "BLOCK", 16)
    rng = random.Random(2)
    base = [f"b{rng.randrange(10**6)}" for _ in range(120)]
    rows = [(i, " ".join(changed(rng, base, 1))) for i in range(90)] + [(1000, "something else " * 3_000), (1001, None)]
    assert kept_ids(make_docs(rows, 4)) == [0, 1000, 1001]


def test_clashing_columns(spark, make_docs):
    from pyspark.sql import functions as F

    names = ["k", "h", "key", "text_hash", "own", "band", "bands", "sketch", "block", "best", "position", "key_of", "hash_of", "a", "b", "node", "root"]
    docs = make_docs([(1, "one two three four five six"), (2, "One two three four five six"), (3, "other")])
    wide = docs.select("*", *[F.lit(n).alias(n) for n in names])
    for stage in (word_overlap.drop_similar, dict(corpus_pipeline.STAGES)["simhash_dedup"]):
        got = stage(wide) if stage is word_overlap.drop_similar else stage(spark, wide, SF)
        assert got.columns == wide.columns and sorted((r.doc_id, r.k) for r in got.collect()) == [(1, "k"), (3, "k")]
