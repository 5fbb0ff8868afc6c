"""Structured Streaming jobs, run to completion over landed copies of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentlens.operators import models
from commentlens.plans import bindings as b
from commentlens.plans.model_queries import ANSWER_SQL, keyword_labeler, nb_predict_sql
from commentlens.plans.registry import query
from commentlens.session import work_folder
from commentlens.streaming import jobs


def _arrivals(spark, parts, job):
    """Land the parts one after the other, each followed by a run of ``job(stream, out, checkpoint)``."""
    folder, run = work_folder(spark, "landed"), work_folder(spark, "stream")
    out = f"{run}/out"
    for part in parts:
        part.write.mode("append").parquet(folder)
        job(jobs.arriving(spark, folder, part.schema), out, f"{run}/checkpoint")
    return out


def _halves(df, key):
    even = F.pmod(F.xxhash64(key), F.lit(2)) == 0
    return [df.filter(even), df.filter(~even)]


CUT = "timestamp_ntz'2024-01-15 12:00:00'"


@query("stream_ingest_dedup", "SELECT event_id, event_type, value FROM events")
def stream_ingest_dedup(spark, sf):
    """Three reads of the events: the second repeats the last six hours of the first, the third is two days late."""
    events = b.table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    late = f"ts < {CUT} - INTERVAL 2 DAYS AND event_id % 50 = 7"
    parts = [
        events.filter(f"ts < {CUT} AND NOT ({late})"),
        events.filter(f"ts >= {CUT} - INTERVAL 6 HOURS"),
        events.filter(late),
    ]
    out = _arrivals(
        spark, parts, lambda s, o, c: jobs.stream_ingest_dedup(s, "event_id", "ts", o, c)
    )
    return spark.read.parquet(f"{out}.parquet").select("event_id", "event_type", "value")


@query(
    "stream_score",
    nb_predict_sql(
        f"SELECT doc_id, comment FROM ({b.MESSY}) m", "r.doc_id, a.predicted AS predicted_sentiment, a.confidence"
    ),
)
def stream_score(spark, sf):
    model = models.fit_candidate(b.labelled(spark, sf), "doc_id", "tfidf_multinomial_nb")
    rows = b.messy(spark, sf).select("doc_id", "comment")
    out = _arrivals(
        spark, _halves(rows, "doc_id"), lambda s, o, c: jobs.stream_score(s, model, "comment", o, c)
    )
    return spark.read.parquet(out).drop("comment")


@query(
    "stream_trend",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus AS label, count(*) AS n
       FROM orders GROUP BY ALL""",
)
def stream_trend(spark, sf):
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    out = _arrivals(
        spark,
        _halves(orders, "o_orderkey"),
        lambda s, o, c: jobs.stream_trend(s, "o_orderdate", "o_orderstatus", o, c),
    )
    return jobs.latest(spark, out).select("month", "label", "n")


@query(
    "stream_daily_trend",
    """SELECT CAST(ts AS DATE) AS day, event_type AS label, count(*) AS n FROM events
       WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 6 HOUR FROM events) GROUP BY ALL""",
)
def stream_daily_trend(spark, sf):
    """The closed days; the events arrive in order of time."""
    events = b.table(spark, sf, "events").select("ts", "event_type")
    parts = [events.filter(f"ts < {CUT}"), events.filter(f"ts >= {CUT}")]
    out = _arrivals(
        spark, parts, lambda s, o, c: jobs.stream_daily_trend(s, "ts", "event_type", o, c)
    )
    return spark.read.parquet(out).select("day", "label", "n")


@query(
    "stream_label_resume",
    f"SELECT doc_id, sha256(text) AS text_sha, {ANSWER_SQL} AS label FROM documents WHERE {ANSWER_SQL} IS NOT NULL",
)
def stream_label_resume(spark, sf):
    """The documents arrive twice; the second time everything is skipped."""
    documents = b.table(spark, sf, "documents").select("doc_id", "text")
    out = _arrivals(
        spark,
        [documents, documents],
        lambda s, o, c: jobs.stream_label_resume(s, "doc_id", "text", keyword_labeler, o, c),
    )
    return spark.read.parquet(f"{out}/labelled.parquet").select("doc_id", "text_sha", "label")
