"""Line dedup against a plain count, and the perfect hash alone."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from commentlens.llm import line_index

LOWER = {i: i + 32 for i in range(65, 91)}


def plain(texts, least):
    def key(line):
        return line.strip(" \t\n\r\x0b\x0c").translate(LOWER)

    held = collections.Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for text in texts:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not key(x) or held[key(x)] < least]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    lines = ["", " ", "\t", "Home | About", " home | ABOUT\t", "ÄRGER", "ärger", "x", " x", "X\r", "\x85"] + [f"line {i}" for i in range(60)]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(8))) for _ in range(150)]
    texts += [None, "", "\n", "\n\n", "word " * 60_000 + "\nHome | About", "only here\nonly here\nonly here"]
    texts += ["a copied text\nof two lines"] * 40
    return [(i if i % 50 else None, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("broadcast", "shard"), [(line_index.BROADCAST, line_index.SHARD), (line_index.BROADCAST, 7), (0, 65_536), (0, 5)])
@pytest.mark.parametrize("least", [2, 10])
def test_against_plain(make_docs, rows, broadcast, shard, least):
    got = line_index.drop_repeated_lines(make_docs(rows, 5), least=least, broadcast=broadcast, shard=shard, carry=["doc_id"])
    want = plain([t for _, t in rows], least)
    found = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()), key=repr)
    assert found == sorted(((k, *w) for (k, _), w in zip(rows, want)), key=repr)


def test_much_probed_shard_is_dealt(make_docs, rows, monkeypatch):
    monkeypatch.setattr(line_index, "PROBES", 10)
    got = line_index.drop_repeated_lines(make_docs(rows, 5), broadcast=0, carry=[])
    assert sorted(r.kept_text for r in got.collect()) == sorted(w[2] for w in plain([t for _, t in rows], 10))


def test_columns_and_empty_table(make_docs):
    names = ["row", "a", "b", "shard", "keys", "gone", "n_lines", "kept_text", "block", "n"]
    docs = make_docs([(i, "same\nown %d" % i) for i in range(12)]).select("*", *[F.lit(n).alias(n) for n in names])
    for size in (line_index.BROADCAST, 0):
        got = line_index.drop_repeated_lines(docs, broadcast=size)
        assert got.columns == ["doc_id", "source", "row", "a", "b", "shard", "keys", "gone", "block", "n", "n_lines", "n_dropped", "kept_text"]
        assert sorted((r.doc_id, r.kept_text, r.gone) for r in got.collect()) == [(i, f"own {i}", "gone") for i in range(12)]
        assert line_index.drop_repeated_lines(make_docs([]), broadcast=size).collect() == []
    with pytest.raises(ValueError):
        line_index.drop_repeated_lines(docs, least=1)


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(5).integers(0, 1 << 63, 20_000, dtype=np.uint64))
    found = line_index.PerfectHash.of(keys)
    assert sorted(found.slots(keys).tolist()) == list(range(len(keys)))
    assert sum(found.sizes) < 4 * len(keys)
    assert line_index.PerfectHash.of(keys[:0]).slots(keys[:3]).tolist() == [-1, -1, -1]


def test_keys_with_one_place_are_kept_apart():
    place, mark = np.array([3, 3, 9, 3], np.int64), np.array([1, 2, 1, 3], np.int64)
    table = pa.table({"shard": pa.array([0] * 4), "place": place, "mark": mark, "n": pa.array([5, 6, 7, 8])})
    row = line_index._shard_arrays(table).to_pylist()[0]
    shard = line_index.Shard(*[row[c] for c in ("bits", "sizes", "marks", "counts", "twins")])
    asked = np.array([(3, 1), (3, 2), (9, 1), (3, 3), (3, 4), (1, 1)], line_index._KEY)
    assert shard.counts(asked).tolist() == [5, 6, 7, 8, 0, 0]
