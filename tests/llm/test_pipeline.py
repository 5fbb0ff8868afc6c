"""Each stage against a plain version of it, and the whole run."""

import collections
import re

import pytest

import corpus_pipeline
from commentlens.llm import mixing
from tests.conftest import SF
from tests.llm.test_mixing import plain_count
from tests.llm.test_packing import check
from tests.llm.test_simhash import plain_components, plain_fingerprint

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    """The smallest table with planted faults: no text, no letters, copies, near copies, a text that is very long."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    base = max((r for r in rows if r[2] == "en"), key=lambda r: len(r[1]))
    planted = [None, "", " \n", "12 34 !?", base[1], base[1].replace(" ", "  \t"), base[1] + " moreover", "word " * 40_000]
    rows += [(100_000 + i, t, None if i % 2 else "en", None if i == 7 else "src0", 0) for i, t in enumerate(planted)]
    return spark.createDataFrame(rows, COLUMNS).repartition(4).cache()


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_keep_columns_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_dedup", "mixing", "packing"]


def test_language_stage_keeps_what_has_letters(spark, docs):
    got = corpus_pipeline.identify_language(spark, docs, SF)
    want = [tuple(r) for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")]
    assert got.columns == docs.columns and as_rows(got) == sorted(want, key=repr)


def test_exact_stage(spark, docs):
    got = corpus_pipeline.drop_copies(spark, docs, SF)
    best = {}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        best.setdefault(re.sub("[ \t-\r]+", " ", r.text or ""), tuple(r))
    assert got.columns == docs.columns and as_rows(got) == sorted(best.values(), key=repr)


def test_near_stage(spark, docs):
    got = corpus_pipeline.drop_near_copies(spark, docs, SF)
    rows = {r.doc_id: r for r in docs.collect()}
    classes = plain_components({k: plain_fingerprint(r.text) for k, r in rows.items()})
    assert got.columns == docs.columns
    assert as_rows(got) == sorted((tuple(rows[k]) for k in set(classes.values())), key=repr)


def test_mixing_stage(spark, docs):
    got = corpus_pipeline.mix_sources(spark, docs, SF)
    rates = {r.source: r.rate for r in mixing.repetition_rates(docs).collect()}
    want = []
    for r in docs.collect():
        want += [tuple(r)] * plain_count("mix", r.doc_id, rates[mixing.MISSING if r.source is None else r.source])
    assert got.columns == docs.columns and as_rows(got) == sorted(want, key=repr)


def test_packing_stage(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    got = corpus_pipeline.pack_windows(spark, docs, SF).collect()
    check(got, {r.doc_id: r.text for r in docs.collect()}, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))


def test_run(spark):
    pieces = corpus_pipeline.run(spark, SF).collect()
    by = collections.Counter(r.doc_id for r in pieces)
    known = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert by and set(by) <= known
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_table(spark):
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.collect() == []
