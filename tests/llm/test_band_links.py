"""The second pass over bands decides where two blocks meet: what it returns are links, not every pair that looks alike."""

import random

import numpy as np
from pyspark.sql import functions as F

from commentlens.llm import word_overlap
from tests.llm.test_across import LINKS, SCHEMA, _own


def _rows(spark, texts, members=None):
    hashes = [word_overlap.shingle_hashes(t.encode(), 5) for t in texts]
    sketches = [(word_overlap.signature(h) >> np.uint64(48)).astype(">u2").tobytes() for h in hashes]
    placed = [(_own(i), 1, i, members or len(texts), s) for i, s in enumerate(sketches)]
    sets = spark.createDataFrame([(_own(i), h.tobytes()) for i, h in enumerate(hashes)], "own struct<key:bigint,text_hash:bigint>, hashes binary")
    return spark.createDataFrame(placed, SCHEMA), lambda own: sets.join(own, "own", "left_semi"), hashes


def test_alike_but_below_the_limit_makes_no_rows(spark, monkeypatch):
    monkeypatch.setattr(word_overlap, "BLOCK", 8)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(30):  # each pair about 0.7 alike: enough for the sketch, too little for a link
        words = list(base)
        for i in rng.sample(range(200), 4):
            words[i] = f"n{rng.randrange(10**9)}"
        texts.append(" ".join(words))
    texts += [texts[3] + " end", texts[20] + " end"]
    placed, sets, hashes = _rows(spark, texts)
    seen = word_overlap.across(placed, spark.createDataFrame([], LINKS)).count()
    got = {(r["b"]["key"], r["a"]["key"]) for r in word_overlap.across(placed, spark.createDataFrame([], LINKS), sets).collect()}
    near = {(i, j) for j in range(32) for i in range(j) if word_overlap.similarity(hashes[i], hashes[j]) >= 0.8}
    assert {(3, 30), (20, 31)} <= got <= near and len(got) < seen


def test_sets_of_neighbouring_sizes_meet_and_blocks_follow_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(word_overlap, "HELD", 8 * 300)
    rng = random.Random(9)
    base = [f"v{i}" for i in range(1000)]
    texts = [" ".join(base[:n]) for n in range(200, 420, 20)] + [" ".join(f"x{rng.randrange(10**6)}" for _ in range(n)) for n in (3, 250, 900)]
    placed, sets, hashes = _rows(spark, texts)
    got = word_overlap.across(placed, spark.createDataFrame([], LINKS), sets)
    roots = {r["node"]["key"]: r["root"]["key"] for r in word_overlap.components(got, "a", "b").collect()}
    assert roots == {i: 0 for i in range(11)}
    assert all(word_overlap.similarity(hashes[r["a"]["key"]], hashes[r["b"]["key"]]) >= 0.8 for r in got.collect())
