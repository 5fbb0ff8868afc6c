"""The audit against a plain one that looks at every term of every pair."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from commentlens.llm import divergence

UPPER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(UPPER))


def plain(rows, least=10, ranks=10):
    """(lang, source, text): all rows of the audit."""
    out = []
    for lang in {r[0] or "" for r in rows}:
        own = [(r[1] or "", words(r[2])) for r in rows if (r[0] or "") == lang]
        docs = collections.Counter(t for _, ws in own for t in set(ws))
        kept = [t for t, n in docs.items() if n >= least]
        counts = {s: collections.Counter() for s, _ in own}
        for s, ws in own:
            counts[s].update(ws)
        whole = sum(counts.values(), collections.Counter())

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            pairs = [(x, sum((p[s][t] - p[x][t]) ** 2 // (p[s][t] + p[x][t]) for t in kept)) for x in counts if x != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(found[:most], 1)]
    return sorted(out)


def audited(spark, rows, **options):
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    return sorted(tuple(r) for r in divergence.audit(docs, **options).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    vocabulary = [f"{a}{b}" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmno"] + ["Über", "ÜBER", "naïve", "日本", "ÄB", " "]
    out = []
    for i in range(240):
        size = rng.choice([0, 3, 30, 200])
        text = " ".join(vocabulary[min(int(rng.expovariate(0.02)), len(vocabulary) - 1)] for _ in range(size))
        out.append((rng.choice(["en", "en", "de", None]), rng.choice(["hot"] * 5 + ["b", "ä", "", None, "z1"]), text + rng.choice([" 12-3", "!", ""])))
    out += [("en", "silent", None), ("en", "mute", ""), ("xx", "a", "few words"), ("xx", "b", None), ("yy", "alone", "x")]
    return out + [("de", "copies", "immer die gleichen Worte")] * 30 + [("de", "long", "wort " * 30_000)]


@pytest.mark.parametrize(("block", "tile"), [(256, 48), (64, 2)])
def test_against_plain(spark, rows, monkeypatch, block, tile):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence.pair_divergence, "__defaults__", (tile,))
    assert audited(spark, rows) == plain(rows)


def test_few_docs_and_no_terms(spark, rows):
    assert audited(spark, rows[:60], least_docs=2) == plain(rows[:60], least=2)
    assert audited(spark, [("en", s, t) for s, t in (("a", None), ("b", "1 2"), ("c", ""))]) == plain([("en", s, None) for s in "abc"])
    assert audited(spark, []) == []


def test_clashing_columns(spark, rows):
    docs = spark.createDataFrame(rows[:80], "lang string, source string, text string")
    names = ["term", "n", "docs", "number", "kept", "total", "order", "block", "tile", "place", "value"]
    wide = docs.select("*", *[F.lit(1).alias(n) for n in names])
    assert sorted(tuple(r) for r in divergence.audit(wide, least_docs=3).collect()) == plain(rows[:80], least=3)


def test_shares_beyond_64_bits(spark):
    counts, totals = [0, 1, 10**10, 10**15], 3 * 10**15
    df = spark.createDataFrame([(c, totals, 7) for c in counts], "n long, total long, kept long")
    got = [r.p for r in df.select("n", divergence._share_column("n", "total").alias("p")).orderBy("n").collect()]
    assert got == [divergence.share(c, totals, 7) for c in counts]
