"""Labelling with a labeler the caller supplies: resumable, with a dead-letter table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens import rules
from commentlens.functions.labels import parse_label
from commentlens.functions.text import comment_hash
from commentlens.operators.sampling import first_by
from commentlens.session import work_folder, written
from commentlens.sources.readers import load_prior_output, path_exists

TASK_ROWS = 10_000  # of a wave that one task deals out, or so

Labeler = Callable[[str], str]


def resume_anti_join(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows not yet processed. Joins on the row's own key and text hash, so copies are no hot key."""
    return df.join(done.select(key, "text_sha"), [key, "text_sha"], "left_anti")


def resume_mismatch(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose text differs from the one processed earlier under the same key."""
    earlier = done.select(key, F.col("text_sha").alias("earlier_sha"))
    return df.join(earlier, key).filter(F.col("text_sha") != F.col("earlier_sha"))


def resume_missing(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows processed earlier whose key the input no longer has."""
    return done.join(df.select(key), key, "left_anti")


def hashed(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(key, F.col(text).alias("comment"), comment_hash(text).alias("text_sha"))


def _ask(labeler: Labeler) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            found, errors = [], []
            for text in frame["comment"]:
                try:
                    found.append(labeler(text))
                    errors.append(None)
                except Exception as exc:  # the caller's labeler may fail in any way
                    found.append(None)
                    errors.append(str(exc))
            yield frame.assign(
                answer=pd.Series(found, index=frame.index, dtype=object),
                error=pd.Series(errors, index=frame.index, dtype=object),
            )

    return answers


def label_batch(
    pending: DataFrame, key: str, labeler: Labeler, max_retries: int = rules.MAX_RETRIES
) -> tuple[DataFrame, DataFrame]:
    """``(labelled, failed)`` for rows of ``(key, comment, text_sha)``.

    Each attempt is one pass over the rows still without a valid label. Its answers are written
    before anything reads them, so no labeler call is ever made twice for one attempt.
    """
    schema = f"{key} {pending.schema[key].dataType.simpleString()}, comment string, text_sha string, " \
             "answer string, error string"
    labelled = None
    for attempt in range(1, max(1, max_retries) + 1):
        asked = written(pending.select(key, "comment", "text_sha").mapInPandas(_ask(labeler), schema), "answers")
        judged = asked.withColumn("label", parse_label("answer"))
        good = judged.filter(F.col("label").isNotNull()).select(key, "comment", "text_sha", "label")
        labelled = good if labelled is None else labelled.unionByName(good)
        pending = judged.filter(F.col("label").isNull())
        if pending.isEmpty():
            break
    invalid = F.format_string("Invalid labeler output: %s", F.coalesce("answer", F.lit("none")))
    failed = pending.select(
        key, "comment", "text_sha", F.coalesce("error", invalid).alias("error"), F.lit(attempt).alias("attempts")
    )
    return labelled, failed


def label_backlog(
    df: DataFrame,
    key: str,
    text: str,
    labeler: Labeler,
    folder: str,
    save_every: int | None = None,
    limit: int | None = None,
    max_retries: int = rules.MAX_RETRIES,
) -> None:
    """Label what ``folder`` does not hold yet and append to its two tables.

    Progress is saved after every ``save_every`` rows or so, unless given a few for each task that works at a
    time; running again goes on where the last run stopped. Rows that failed count as processed. Raises when
    earlier output belongs to other texts, or to rows that the input no longer has.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    base = f"{key} {kind}, comment string, text_sha string"
    rows = hashed(df, key, text)
    done = load_prior_output(spark, f"{folder}/labelled.parquet", f"{base}, label string").select(
        key, "text_sha"
    ).unionByName(
        load_prior_output(
            spark, f"{folder}/failed.parquet", f"{base}, error string, attempts int"
        ).select(key, "text_sha")
    )
    if not resume_mismatch(rows, done, key).isEmpty():
        raise ValueError("the input no longer matches the texts labelled earlier")
    if not resume_missing(rows, done, key).isEmpty():
        raise ValueError("the input lacks rows that were labelled earlier")
    pending = resume_anti_join(rows, done, key)
    if limit is not None:
        pending = first_by(pending, [key], limit)
    pending = written(pending, "backlog")
    save_every = save_every or rules.SAVE_EVERY * spark.sparkContext.defaultParallelism
    waves = max(1, -(-pending.count() // save_every))
    queue = work_folder(spark, "waves")
    parts = -(-save_every // TASK_ROWS)  # so that a long wave is several tasks and files
    part = F.pmod(F.xxhash64(F.lit("part"), key), F.lit(parts))
    dealt = pending.withColumn("wave", F.pmod(F.xxhash64(key), F.lit(waves)).cast("int")).repartition("wave", part)
    dealt.write.partitionBy("wave").parquet(queue)
    # Each wave is a folder of its own, so the backlog is read once, however often progress is saved.
    for wave in range(waves):
        if not path_exists(spark, f"{queue}/wave={wave}"):
            continue
        part = spark.read.schema(pending.schema).parquet(f"{queue}/wave={wave}")
        labelled, failed = label_batch(part, key, labeler, max_retries)
        failed.write.mode("append").parquet(f"{folder}/failed.parquet")
        labelled.write.mode("append").parquet(f"{folder}/labelled.parquet")
