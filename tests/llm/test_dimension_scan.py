import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from commentlens.llm import dimension_scan

ASKED = "vec_id % 10 = 0"


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)


def plain(rows, asked, k=5):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v]
    usable = [(i, v) for i, v in usable if np.isfinite(v).all() and v.any()]
    out = {}
    for q, a in usable:
        if asked(q):
            scored = sorted((-(a @ b) / (np.linalg.norm(a) * np.linalg.norm(b)), i) for i, b in usable if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall_of(got, want):
    hits = [len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / max(len(w), 1) for q, w in want.items()]
    return sum(hits) / len(hits)


@pytest.mark.parametrize("clustered", [False, True])
def test_recall(spark, monkeypatch, clustered):
    monkeypatch.setattr(dimension_scan, "LIST_SIZE", 50)
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((3000, 48))
    if clustered:
        vectors = vectors * 0.3 + rng.standard_normal((20, 48))[rng.integers(0, 20, 3000)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    got = found(dimension_scan.nearest(frame(spark, rows), ASKED))
    want = plain(rows, lambda i: i % 10 == 0)
    assert got.keys() == want.keys() and recall_of(got, want) >= 0.93
    for q, answers in got.items():
        exact = {i: s for i, s in plain([rows[q], *(rows[i] for i, _ in answers)], lambda i: i == q)[q]}
        assert all(s == pytest.approx(exact[i], abs=1e-12) for i, s in answers)


def test_copies_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(dimension_scan, "BLOCK", 7)
    rng = random.Random(2)
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(30)]
    rows = [(i, base[0] if i % 3 == 0 else base[i % 30]) for i in range(300)]
    rows += [(rows[0][0], rows[0][1])]  # a row twice
    got = found(dimension_scan.nearest(frame(spark, rows), ASKED))
    want = plain(rows[:-1], lambda i: i % 10 == 0)
    assert {q: [i for i, _ in a] for q, a in got.items()} == {q: [i for i, _ in a] for q, a in want.items()}


def test_odd_vectors_take_no_part(spark):
    good = [[1.0, 0.0, 0.5], [0.9, 0.1, 0.5], [1e-30, 0.0, 1e-30]]
    rows = [(0, good[0]), (10, good[1]), (3, good[2]), (20, None), (30, [0.0, 0.0, 0.0]), (40, [1.0, None, 2.0])]
    rows += [(50, [math.nan, 1.0, 1.0]), (60, [math.inf, 1.0, 1.0]), (70, []), (80, [1.0, 2.0]), (None, good[0])]
    docs = frame(spark, rows).withColumns({"name": F.lit("n"), "list": F.lit(1), "rank": F.lit(2)})
    got = found(dimension_scan.nearest(docs, ASKED))
    assert {q: [i for i, _ in a] for q, a in got.items()} == {0: [10, 3], 10: [0, 3]}
    assert got[0][0][1] == pytest.approx(plain(rows[:2], lambda i: i == 0)[0][0][1], abs=1e-12)


def test_few_and_none(spark):
    assert found(dimension_scan.nearest(frame(spark, [(0, [1.0, 2.0])]), ASKED)) == {}
    assert dimension_scan.nearest(frame(spark, []), ASKED).collect() == []


def test_scan_abandons_only_what_is_far():
    rng = np.random.default_rng(3)
    unit = dimension_scan.unit_vectors(rng.standard_normal((2000, 64)))
    blocks = [unit[:, e : e + 16] for e in range(0, 64, 16)]
    query = dimension_scan.unit_vectors(rng.standard_normal((1, 64)))[0]
    near = dimension_scan.scan(query, np.inf, blocks, [query[e : e + 16] for e in range(0, 64, 16)], 6)
    best = np.argsort(((unit - query) ** 2).sum(axis=1))[:6]
    assert set(best) <= set(near) and len(near) < 12
