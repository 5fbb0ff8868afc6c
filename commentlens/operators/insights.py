"""Summaries, trends and distinctive words of labelled or scored comments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commentlens import rules
from commentlens.functions.dates import lenient_timestamp
from commentlens.functions.tokens import tokenize_words


def sentiment_summary(df: DataFrame, sentiment: str = "predicted_sentiment") -> DataFrame:
    """One row: total, counts, percentages, most common sentiment, insight sentences."""
    if sentiment not in df.columns:
        raise ValueError(f"no '{sentiment}' column; available: {df.columns}")
    label = F.col(sentiment)
    counts = df.agg(
        F.count_if(label.isin(rules.LABELS)).alias("total_comments"),
        *[F.count_if(label == x).alias(f"count_{x}") for x in rules.LABELS],
    )
    total = F.col("total_comments")
    shares = [
        F.when(total > 0, F.round(F.lit(100.0) * F.col(f"count_{x}") / total, 2))
        .otherwise(F.lit(0.0))
        .alias(f"percentage_{x}")
        for x in rules.LABELS
    ]
    largest = F.greatest(*[F.col(f"count_{x}") for x in rules.LABELS])
    most_common = F.coalesce(
        *[F.when((total > 0) & (F.col(f"count_{x}") == largest), x) for x in rules.LABELS]
    )
    rows = counts.select("*", *shares, most_common.alias("most_common_sentiment"))
    share_of = {x: F.col(f"percentage_{x}").cast("string") for x in rules.LABELS}
    top_share = F.coalesce(
        *[F.when(F.col("most_common_sentiment") == x, share_of[x]) for x in rules.LABELS]
    )
    sentences = F.array(
        F.format_string(
            rules.INSIGHT_MOST_COMMON, total.cast("string"), "most_common_sentiment", top_share
        ),
        F.format_string(rules.INSIGHT_SHARE, F.lit("Negative"), share_of["Negative"]),
        F.format_string(rules.INSIGHT_SHARE, F.lit("Positive"), share_of["Positive"]),
        F.lit(rules.INSIGHT_CAVEAT),
    )
    insights = F.when(total > 0, sentences).otherwise(F.array(F.lit(rules.INSIGHT_NOTHING)))
    return rows.withColumn("insights", insights)


def monthly_trend(df: DataFrame, date: str, sentiment: str) -> DataFrame:
    """Comments per month and label; rows without a readable date are left out."""
    month = F.date_trunc("month", lenient_timestamp(F.col(f"`{date}`"))).cast("date")
    dated = df.filter(F.col(f"`{sentiment}`").isNotNull()).select(month.alias("month"), F.col(f"`{sentiment}`").alias("sentiment"))
    # A filter on the month before the aggregate would have every date read twice.
    counts = dated.groupBy("month").agg(*[F.count_if(F.col("sentiment") == x).alias(x) for x in rules.LABELS])
    return counts.filter(F.col("month").isNotNull())


def doc_frequency(df: DataFrame, text: str = "comment") -> DataFrame:
    """Documents per word."""
    words = df.select(F.explode(tokenize_words(text)).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("docs"))


def distinctive_words(df: DataFrame, min_docs: int = rules.MIN_WORD_DOCS) -> DataFrame:
    """Per label: how much more often its comments hold a word than the other comments do.

    One aggregate over all words counts every label at once.
    """
    rows = df.select("label", "comment").filter(F.col("comment").isNotNull())
    per_label = [F.count_if(F.col("label") == x).alias(x) for x in rules.LABELS]
    words = rows.select("label", F.explode(tokenize_words("comment")).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n_word"), *per_label)
    scored = F.array(
        *[F.struct(F.lit(x).alias("label"), F.col(x).alias("docs_in")) for x in rules.LABELS]
    )
    counts = counts.select("word", "n_word", F.inline(scored)).filter(F.col("docs_in") >= min_docs)
    sizes = rows.agg(F.count("*").alias("n_all"), *per_label).select("n_all", F.inline(
        F.array(*[F.struct(F.lit(x).alias("label"), F.col(x).alias("n_in")) for x in rules.LABELS])
    ))
    joined = counts.join(F.broadcast(sizes), "label")  # three rows
    inside = F.col("docs_in") / F.col("n_in")
    outside = (F.col("n_word") - F.col("docs_in") + 1) / (F.col("n_all") - F.col("n_in") + 1)
    return joined.select("label", "word", "docs_in", (inside / outside).alias("score"))


def topk_words(df: DataFrame, k: int = rules.TOP_WORDS) -> DataFrame:
    """The ``k`` most distinctive words per label; each task keeps its own top ``k`` first."""
    best = Window.partitionBy("label").orderBy(F.desc("score"), "word")
    ranked = distinctive_words(df).withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= k)
