import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from commentlens.llm import content_sort
from commentlens.llm.content_sort import Splitter


def norm(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def plain(rows):
    groups = {}
    for doc, text, *_ in rows:
        groups.setdefault(norm(text), []).append(doc)
    out = []
    for text, ids in groups.items():
        low = min((i for i in ids if i is not None), default=None)
        best = sorted(ids, key=lambda i: (i is None, i))
        for n, i in enumerate(best):
            out.append((i, low, len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=repr)


ROWS = [(1, None), (2, ""), (3, " "), (4, "\t\n"), (5, "a  b"), (6, "a b"), (7, "a\x0bb"), (8, "a b "), (9, "é" * 50_000)]


def test_small_cases(make_docs):
    assert found(content_sort.sort_by_content(make_docs(ROWS))) == plain(ROWS)


@pytest.mark.parametrize("ranges", [1, 5, 23])
def test_hot_group_is_dealt_over_ranges(make_docs, ranges):
    rng = random.Random(ranges)
    rows = [(i, rng.choice(["hot text", "", f"text {rng.randrange(80)}", f"text\t{rng.randrange(9)}"])) for i in range(500)]
    rows += [(None, "hot text"), (None, "only  here"), (None, "only here"), (3, rows[3][1]), (3, rows[3][1])]
    df = content_sort.sort_by_content(make_docs(rows), ranges=ranges)
    assert found(df) == plain(rows)
    if ranges == 23:
        places = df.withColumn("p", F.spark_partition_id()).filter("text = 'hot text'").select("p").distinct()
        assert places.count() > 3
    kept = content_sort.drop_exact_copies(make_docs(rows), ranges=ranges).collect()
    assert sorted((str(r.doc_id), norm(r.text)) for r in kept) == sorted((str(p[0]), t) for p, t in zip(
        [p for p in plain(rows) if p[3]],
        [{hashlib.sha256(norm(t).encode()).hexdigest(): norm(t) for _, t in rows}[p[4]] for p in plain(rows) if p[3]],
    ))


def test_splitters_are_short_unless_a_group_is_cut():
    sample = [("apple pie", 1), ("apple tart", 2), ("pear", 3), ("pear", 4), ("pear", 5), ("quince jam", 6)]
    got = content_sort.choose_splitters(sample, 6)
    assert got == [Splitter("apple t"), Splitter("pear"), Splitter("pear", 4), Splitter("pear", 5), Splitter("q")]


def test_clashing_columns_and_empty(make_docs):
    docs = make_docs([(1, "x"), (2, "x")]).withColumns({"norm": F.lit("n"), "range": F.lit(1), "low": F.lit(0), "kept": F.lit("k")})
    got = content_sort.sort_by_content(docs)
    assert {"norm", "range", "low"} <= set(got.columns) and got.columns.count("kept") == 1
    assert [(r.doc_id, r.kept, r.norm) for r in got.orderBy("doc_id").collect()] == [(1, True, "n"), (2, False, "n")]
    kept = content_sort.drop_exact_copies(docs)
    assert kept.columns == docs.columns and [(r.doc_id, r.kept) for r in kept.collect()] == [(1, "k")]
    assert content_sort.sort_by_content(make_docs([])).collect() == []


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y")], "doc_id string, text string")
    assert found(content_sort.sort_by_content(docs)) == plain([("b", "x"), ("a", "x"), ("c", "y")])


def test_native_only(make_docs):
    plan = content_sort.sort_by_content(make_docs(ROWS))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
