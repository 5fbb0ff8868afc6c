"""The queries' digests against plain versions on the smallest tables; tests/test_queries.py compares those with SQL."""

import zlib

import numpy as np
import pytest

from commentlens.llm import queries
from tests.conftest import SF
from tests.llm.test_dimension_scan import plain as plain_nearest
from tests.llm.test_dimension_scan import recall_of
from tests.llm.test_hashed_maxent import plain_base
from tests.llm.test_packing import check
from tests.llm.test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def mod(key, modulus):
    return zlib.crc32(str(key).encode()) % modulus


def test_op1(spark, docs):
    got = queries.QUERIES["op1_hashed_maxent"](spark, SF)
    assert got.columns[:7] == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = [(k, r.text) for k, r in docs.items()]
    want = plain_base(rows, [r for r in rows if mod(r[0], 7) != 2])
    found = got.collect()
    for r in found:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3] and r.held_out == (mod(r.doc_id, 7) == 2)
        assert r.base_score == pytest.approx(want[r.doc_id][3], rel=1e-9)
    held = [r for r in found if r.held_out]
    assert len(found) == len(docs) and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_op3(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = plain_nearest(rows, lambda i: i % 50 == 0)
    got = {}
    for r in sorted(queries.QUERIES["op3_dimension_scan"](spark, SF).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert recall_of(got, want) >= 0.9 and all(len(a) == 5 for a in got.values())
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, answers in got.items():
        for i, s in answers:
            a, b = vectors[q], vectors[i]
            assert s == pytest.approx(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b), abs=1e-12)


def test_op4(spark, docs):
    from tokenizers import Tokenizer

    got = queries.QUERIES["op4_packing"](spark, SF).collect()
    check(got, {k: r.text for k, r in docs.items()}, Tokenizer.from_file(queries.tokenizer_file()))
    lengths = {}
    for r in got:
        lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
    padding = sum(2048 - n for n in lengths.values() if n & (n - 1))
    assert padding < 0.03 * sum(lengths.values())


def test_op5(spark, docs):
    got = queries.QUERIES["op5_language_id"](spark, SF).collect()
    assert len(got) == len(docs) and all(r.held_out == (mod(r.doc_id, 3) == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_op6(spark, docs):
    got = {r.doc_id: r for r in queries.QUERIES["op6_simhash"](spark, SF).collect()}
    prints = {k: plain_fingerprint(r.text) for k, r in docs.items()}
    classes = plain_components(prints)
    assert {k: (r.fingerprint, r.component_id) for k, r in got.items()} == {
        k: (f"{p:016x}", classes[k]) for k, p in prints.items()
    }
