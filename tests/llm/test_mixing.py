import collections
import decimal
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from commentlens.llm import mixing


def plain_count(seed, key, mean):
    u = (int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    k, p = 0, math.exp(-mean)
    cdf = p
    while cdf < u and k < mean + 12 * math.sqrt(mean) + 40:
        k += 1
        p = p * mean / k
        cdf += p
    return k


@pytest.mark.parametrize("mean", [0.0, 0.01, 1.0, 7.5, 300.0])
def test_quantile(spark, mean):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    got = keys.select("k", mixing.poisson_quantile(mixing.uniform("s", F.col("k")), F.lit(mean)).alias("n")).collect()
    assert all(r.n == plain_count("s", r.k, mean) for r in got)
    average = sum(r.n for r in got) / 3000
    assert abs(average - mean) <= 4 * math.sqrt(mean / 3000)


def test_rates_too_large_are_refused(spark):
    with pytest.raises(Exception, match="over 700"):
        spark.range(1).select(mixing.poisson_quantile(F.lit(0.5), F.lit(701.0))).collect()


def docs_of(make_docs):
    rows = [(i, "word " * 10, "hot") for i in range(900)] + [(i, "longer word " * 20, "b") for i in range(900, 1200)]
    return make_docs(rows + [(i, "none", None) for i in range(1200, 1300)])


def test_shares_follow_targets(make_docs):
    docs = docs_of(make_docs)
    mixed = mixing.mix(docs, targets={"hot": 1.0, "b": 2.0, None: 1.0}, size=3.0)
    volume = collections.Counter()
    copies = collections.Counter()
    for r in mixed.collect():
        volume[r.source] += len(r.text)
        copies[r.doc_id] += 1
        assert r.copy <= 1000
    total = docs.agg(F.sum(F.length("text"))).first()[0] * 3
    for source, share in (("hot", 0.25), ("b", 0.5), (None, 0.25)):
        assert volume[source] == pytest.approx(share * total, rel=0.1)
    rates = {r.source: r.rate for r in mixing.repetition_rates(docs, targets={"hot": 1.0, "b": 2.0, None: 1.0}, size=3.0).collect()}
    assert all(copies[i] == plain_count("mix", i, rates["hot"]) for i in range(900))


def test_same_whatever_the_partitions(make_docs, monkeypatch):
    docs = docs_of(make_docs)
    once = {(r.doc_id, r.copy) for r in mixing.mix(docs).collect()}
    monkeypatch.setattr(mixing, "BROADCAST", 0)  # rates that do not fit meet the rows by a shuffle
    assert once == {(r.doc_id, r.copy) for r in mixing.mix(docs.repartition(7)).collect()}
    assert once != {(r.doc_id, r.copy) for r in mixing.mix(docs, seed="other").collect()}


def test_order_is_shuffled(make_docs):
    order = [r.doc_id for r in mixing.mix(docs_of(make_docs)).collect()]
    rising = sum(a < b for a, b in zip(order, order[1:]))
    assert 0.4 < rising / len(order) < 0.6


def test_nulls_repeats_clashes_and_empty(make_docs):
    docs = make_docs([(1, None, "a"), (2, "", "b"), (None, "text", "c"), (3, "text", "c"), (3, "text", "c")])
    docs = docs.withColumns({"rate": F.lit("r"), "mean": F.lit("m"), "from_source": F.lit("f"), "nth": F.lit(1)})
    got = mixing.mix(docs, targets={"c": 1.0}).collect()
    count = collections.Counter(r.doc_id for r in got)
    assert count[3] % 2 == 0 and all(r.mean == "m" and r.from_source == "f" for r in got)
    assert all(r.rate == 1.0 for r in got if r.doc_id in (1, 2))
    assert mixing.mix(make_docs([])).collect() == []


def decimal_counts(us, mean):
    """The quantiles by plain sums of 60 digits from 0 on."""
    with decimal.localcontext() as c:
        c.prec, c.Emin = 60, -(10**9)
        exact = decimal.Decimal(mean)
        p = cdf = (-exact).exp()
        k, found = 0, []
        for u in sorted(us):
            while cdf < decimal.Decimal(u):
                k += 1
                p = p * exact / k
                cdf += p
            found.append(k)
    return found


@pytest.mark.parametrize("mean", [699.5, 700.5, 1000.25, 40_000.75])
def test_every_mean_has_its_quantile(spark, mean):
    us = [2.0**-53, 1e-9, 0.01, 0.3, 0.5, 0.77, 0.999, 1 - 2.0**-40]
    rows = spark.createDataFrame([(u, mean) for u in us], "u double, mean double")
    got = rows.orderBy("u").select(mixing.poisson_count(F.col("u"), F.col("mean")).alias("k")).collect()
    assert [r.k for r in got] == decimal_counts(us, mean)


def test_a_tiny_source_beside_a_huge_volume(make_docs):
    rows = [(i, "long text " * 100_000, "big") for i in range(30)] + [(100, "a", "tiny"), (101, "b", None)]
    docs = make_docs(rows)
    rates = {r.source: r.rate for r in mixing.repetition_rates(docs).collect()}
    assert rates["tiny"] > 5000
    tiny = mixing.mix(docs.filter("length(text) < 2").unionByName(docs.filter("doc_id = 0")), targets={"big": 1, "tiny": 1, None: 1})
    copies = collections.defaultdict(list)
    for r in tiny.filter("doc_id >= 100").select("doc_id", "copy", "rate").collect():
        copies[r.doc_id].append(r.copy)
        assert r.rate > 300_000
    for numbers in copies.values():
        assert sorted(numbers) == list(range(1, len(numbers) + 1))
        assert len(numbers) == pytest.approx(1_000_002 / 3, rel=0.01)
    assert set(copies) == {100, 101}
    counted = mixing.mix(docs).groupBy("doc_id").count().filter("doc_id >= 100").collect()
    assert all(abs(r["count"] - rates["tiny"]) < 6 * math.sqrt(rates["tiny"]) for r in counted) and len(counted) == 2
