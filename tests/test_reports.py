"""Summaries, metrics, words, lookup and conversations against brute force."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from commentlens import rules
from commentlens.operators import dialog, insights, lookup, metrics


def test_summary(spark):
    df = spark.createDataFrame([(x,) for x in ["Neutral", "Negative", "Negative", "Neutral", None, "Mixed"]], "predicted_sentiment string")
    row = insights.sentiment_summary(df).first()
    assert (row["total_comments"], row["most_common_sentiment"], row["percentage_Negative"]) == (4, "Negative", 50.0)
    assert row["insights"][0] == "Of the 4 analyzed comments, Negative is the most frequently observed sentiment (50.0%)."
    assert row["insights"][1] == "Negative sentiment was observed in 50.0% of analyzed comments."
    nothing = insights.sentiment_summary(df.filter("predicted_sentiment = 'Mixed'")).first()
    assert nothing["most_common_sentiment"] is None and nothing["insights"] == [rules.INSIGHT_NOTHING]
    with pytest.raises(ValueError):
        insights.sentiment_summary(df, "other")


def test_trend(spark):
    rows = [("2024-01-31", "Positive"), ("2024-01-02T05:00:00", "Mixed"), ("bad", "Neutral"), ("2024-03-01", "Neutral"), ("2024-03-02", None)]
    df = spark.createDataFrame(rows, "`attributes.postedDate` string, s string")
    got = insights.monthly_trend(df, "attributes.postedDate", "s").orderBy("month").collect()
    assert [(str(r["month"]), r["Positive"], r["Negative"], r["Neutral"]) for r in got] == [("2024-01-01", 1, 0, 0), ("2024-03-01", 0, 0, 1)]


def test_metrics_by_hand(spark):
    pairs = [("Positive", "Positive")] * 3 + [("Positive", "Negative")] + [("Negative", "Negative")] * 2 + [("Neutral", "Negative")]
    df = spark.createDataFrame(pairs, "label string, predicted string")
    row = metrics.classification_metrics(df).first()
    assert row["accuracy"] == round(5 / 7, 4)
    assert row["per_class"]["Neutral"].asDict() == {"precision": 0.0, "recall": 0.0, "f1": 0.0, "support": 1}
    assert row["per_class"]["Negative"]["precision"] == 0.5 and row["per_class"]["Negative"]["recall"] == 1.0
    f1 = [2 * 3 / 7, 2 * 2 / 6, 0]
    assert row["f1_macro"] == round(sum(f1) / 3, 4)
    assert row["f1_weighted"] == round((f1[0] * 4 + f1[1] * 2) / 7, 4)
    assert row["confusion_matrix"] == [[3, 1, 0], [0, 2, 0], [0, 1, 0]]
    lines = [r["text"] for r in metrics.classification_report(df).orderBy("line").collect()]
    assert len(lines) == 7 and lines[1].split() == ["Positive", "1.00", "0.75", "0.86", "4"]


def test_ranking_prefers_earlier_on_a_tie(spark):
    rows = [(0, "a", 0.5, 0.7, 0.6), (1, "b", 0.9, 0.7, 0.6), (2, "c", 0.9, 0.7, 0.6)]
    df = spark.createDataFrame(rows, "candidate int, model string, accuracy double, f1_macro double, f1_weighted double")
    assert [r["model"] for r in metrics.rank_models(df).collect()] == ["b", "c", "a"]


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"word{c}" for c in "abcdefghijklmnopqrstuvwxyz"] + ["the", "tax", "rule"]
    return [" ".join(rng.choices(words, k=rng.randint(1, 9))) for _ in range(n)]


def test_distinctive_words(spark):
    rng = random.Random(2)
    rows = [(i, t, rng.choice(rules.LABELS)) for i, t in enumerate(corpus(120))]
    df = spark.createDataFrame(rows, "id int, comment string, label string")
    got = {(r["label"], r["word"]): r["score"] for r in insights.distinctive_words(df).collect()}
    expected = {}
    for label in rules.LABELS:
        inside = [set(re.findall("[a-z']+", t)) for _, t, x in rows if x == label]
        outside = [set(re.findall("[a-z']+", t)) for _, t, x in rows if x != label]
        n_in, n_out = Counter(w for s in inside for w in s), Counter(w for s in outside for w in s)
        for w, c in n_in.items():
            if c >= 3 and len(w) > 2 and w not in rules.ALL_STOP_WORDS:
                expected[label, w] = (c / len(inside)) / ((n_out[w] + 1) / (len(outside) + 1))
    assert got == pytest.approx(expected)
    top = insights.topk_words(df, 2).collect()
    assert len(top) == 6 and all(r["score"] >= 0 for r in top)


@pytest.mark.parametrize("frequent_from", [lookup.FREQUENT, 5, 1, 0])
def test_best_document(spark, frequent_from):
    """Against a plain loop, whatever counts as a frequent word; one word is everywhere."""
    docs = [(d, t + " everywhere") for d, t in enumerate(corpus(30, 3))]
    questions = list(enumerate([t + " everywhere" for t in corpus(50, 4)] + ["everywhere", "zz unknownword", "", None]))
    found = lookup.keyword_overlap_match(
        spark.createDataFrame(questions, "q bigint, t string").repartition(3), "q", "t",
        spark.createDataFrame(docs, "d bigint, t string"), "d", "t", frequent_from,
    ).collect()
    expected = []
    for q, text in questions:
        words = set(re.findall("[a-z]{3,}", text or ""))
        scores = [(-len(words & set(re.findall("[a-z]{3,}", t))), d) for d, t in docs]
        best, d = min(scores)
        expected.append((q, d if best else None, -best))
    assert sorted(tuple(r) for r in found) == expected


def test_conversations(spark):
    rows = [(1, i, ["user", "assistant", "tool"][i % 3], f"m{i}") for i in range(9)] + [(2, 0, "user", "hi")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    contents = {r["conv_id"]: r["contents"] for r in dialog.chat_contents(df).collect()}
    assert [m["parts"][0]["text"] for m in contents[1]] == [f"m{i}" for i in range(3, 9)]
    assert [m["role"] for m in contents[1]][:3] == ["user", "model", "tool"]
    assert len(contents[2]) == 1
    prompt = spark.range(1).select(dialog.build_prompt(F.lit("ctx 100%s"), F.lit("why?"))).first()[0]
    assert prompt.startswith("REGULATORY CONTEXT:\nctx 100%s\n\nUSER QUESTION:\nwhy?\n\nAnswer using ONLY")


def test_long_conversation_is_trimmed_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS conv_id", "id AS turn", "'user' AS role", "'x' AS text")
    plan = dialog.history_trim(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_sketches_merge_within_their_error(spark):
    from commentlens.operators import quality

    rng = random.Random(4)
    sizes = [int(rng.expovariate(0.01)) for _ in range(6000)]
    rows = spark.createDataFrame([(i % 7, "x" * n) for i, n in enumerate(sizes)], "part int, norm string").repartition(5)
    parts = quality.length_sketches(rows, "norm", ["part"])
    assert parts.count() == 7
    for r in quality.length_estimates(quality.merge_length_sketches(parts)).filter("measure = 'chars'").collect():
        assert (r["rows"], r["least"], r["most"]) == (6000, min(sizes), max(sizes))
        below, reached = (sum(n < r["estimate"] for n in sizes), sum(n <= r["estimate"] for n in sizes))
        assert below / 6000 <= r["share"] + quality.RANK_ERROR and reached / 6000 >= r["share"] - quality.RANK_ERROR
    assert quality.length_estimates(quality.length_sketches(rows.limit(0), "norm")).collect() == []
