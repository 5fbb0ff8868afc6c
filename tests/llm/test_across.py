"""Pairs that other members of a band stand between, and memory that workers keep."""

import numpy as np

from commentlens.llm import common, word_overlap

SCHEMA = "own struct<key:bigint,text_hash:bigint>, band bigint, position bigint, members bigint, sketch binary"
LINKS = "a struct<key:bigint,text_hash:bigint>, b struct<key:bigint,text_hash:bigint>"


def _own(i):
    return {"key": i, "text_hash": 7 * i}


def _placed(spark, same, n=40):
    rng = np.random.default_rng(5)
    sketches = rng.integers(0, 1 << 16, (n, word_overlap.BANDS * word_overlap.ROWS)).astype(">u2")
    for a, b in same:
        sketches[b] = sketches[a]
    return spark.createDataFrame([(_own(i), 1, i, n, sketches[i].tobytes()) for i in range(n)], SCHEMA)


def test_members_of_a_band_meet_across_blocks_and_neighbours(spark, monkeypatch):
    monkeypatch.setattr(word_overlap, "BLOCK", 8)
    same = [(3, 30), (12, 15), (1, 14)]
    found = word_overlap.across(_placed(spark, same), spark.createDataFrame([], LINKS)).collect()
    assert sorted((r["b"]["key"], r["a"]["key"]) for r in found) == sorted(same)


def test_members_of_one_class_are_not_met_again(spark):
    links = spark.createDataFrame([(_own(i), _own(0)) for i in range(1, 40)], LINKS)
    assert word_overlap.across(_placed(spark, [(3, 30)]), links) is None
    links = spark.createDataFrame([(_own(30), _own(3))], LINKS)
    assert word_overlap.across(_placed(spark, [(3, 30)]), links).collect() == []


def test_stores_of_other_operators_are_emptied():
    common.worker_store("some_operator")["x"] = 1
    common.leave_stores()
    assert common.worker_store("some_operator") == {}
