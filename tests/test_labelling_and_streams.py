"""Resumable labelling and the incremental jobs."""

import pytest
from pyspark.sql import functions as F

from commentlens.operators import labeling
from commentlens.session import work_folder
from commentlens.streaming import jobs


def labeler(text):
    if text.startswith("fail"):
        raise RuntimeError("no model")
    return "unsure" if text.startswith("odd") else f"<think>x</think> {text.split()[0]}"


def texts(spark, rows):
    return spark.createDataFrame(rows, "id bigint, t string")


ROWS = [(1, "positive a"), (2, "NEGATIVE b"), (3, "odd c"), (4, "fail d"), (5, "positive a")]


def test_attempts_and_dead_letters(spark):
    good, failed = labeling.label_batch(labeling.hashed(texts(spark, ROWS), "id", "t"), "id", labeler)
    assert sorted((r["id"], r["label"]) for r in good.collect()) == [(1, "Positive"), (2, "Negative"), (5, "Positive")]
    assert sorted((r["id"], r["error"], r["attempts"]) for r in failed.collect()) == [
        (3, "Invalid labeler output: unsure", 3), (4, "no model", 3)]


def test_resume(spark):
    folder = work_folder(spark, "labels")
    df = texts(spark, ROWS)

    def state():
        return [
            sorted(r["id"] for r in spark.read.parquet(f"{folder}/{n}.parquet").collect()) for n in ("labelled", "failed")
        ]

    labeling.label_backlog(df, "id", "t", labeler, folder, limit=3)
    assert state() == [[1, 2], [3]]
    labeling.label_backlog(df, "id", "t", labeler, folder, save_every=1)
    assert state() == [[1, 2, 5], [3, 4]]
    labeling.label_backlog(df, "id", "t", labeler, folder)
    assert state() == [[1, 2, 5], [3, 4]]
    with pytest.raises(ValueError, match="no longer matches"):
        labeling.label_backlog(texts(spark, [(1, "another text")]), "id", "t", labeler, folder)
    with pytest.raises(ValueError, match="lacks rows"):
        labeling.label_backlog(texts(spark, ROWS[:2]), "id", "t", labeler, folder)


def test_stream_equals_batch(spark):
    folder, out, check = (work_folder(spark, n) for n in ("in", "out", "check"))
    rows = spark.range(200).selectExpr(
        "id", "timestamp_seconds(1704067200 + id * 3600 * 5) AS ts", "IF(id % 3 = 0, 'a', 'b') AS label"
    )
    rows.filter("id < 120").coalesce(1).write.parquet(folder)

    def run():
        jobs.stream_trend(jobs.arriving(spark, folder, rows.schema), "ts", "label", out, check)
        return sorted(tuple(r) for r in jobs.latest(spark, out).select("month", "label", "n").collect())

    def batch(df):
        month = F.trunc(F.col("ts").cast("date"), "month").alias("month")
        return sorted(tuple(r) for r in df.groupBy(month, "label").count().collect())

    assert run() == batch(rows.filter("id < 120"))
    rows.filter("id >= 120").coalesce(1).write.mode("append").parquet(folder)
    assert run() == batch(rows)


def test_stream_dedup_over_runs(spark):
    folder, out, check = (work_folder(spark, n) for n in ("in", "out", "check"))
    rows = spark.range(50).selectExpr("id", "timestamp_seconds(1704067200 + id * 60) AS ts")
    rows.coalesce(1).write.parquet(folder)
    jobs.stream_ingest_dedup(jobs.arriving(spark, folder, rows.schema), "id", "ts", out, check)
    more = spark.range(40, 70).selectExpr("id", "timestamp_seconds(1704067200 + id * 60) AS ts")
    more.coalesce(1).write.mode("append").parquet(folder)
    jobs.stream_ingest_dedup(jobs.arriving(spark, folder, rows.schema), "id", "ts", out, check)
    # Ten hours behind the newest row: a new id and a repeated one.
    late = spark.range(69, 71).selectExpr("id", "timestamp_seconds(1704067200 - 36000 + id * 60) AS ts")
    late.coalesce(1).write.mode("append").parquet(folder)
    jobs.stream_ingest_dedup(jobs.arriving(spark, folder, rows.schema), "id", "ts", out, check)
    assert sorted(r["id"] for r in spark.read.parquet(f"{out}.parquet").collect()) == list(range(71))


def test_many_small_batches_read_no_earlier_output(spark, monkeypatch):
    """Thirty arrivals, each with new ids, ids of all earlier batches, and repeated ids of which the earliest stays."""
    folder, out, check = (work_folder(spark, n) for n in ("in", "out", "check"))
    for i in range(30):
        rows = [(k, 1000 * i - k, f"batch {i}") for k in range(3 * i, 3 * i + 3)]
        rows += [(k, t + 7, f"later {i}") for k, t, _ in rows] + [(k, -9, "again") for k in range(0, 3 * i, 5)] + [(None, 0, "none")]
        df = spark.createDataFrame(rows, "id bigint, at bigint, note string").coalesce(1)
        df.write.mode("append").parquet(folder)
    reads = []
    plain = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *a, **k: reads.append(a) or plain(self, *a, **k))
    stream = jobs.arriving(spark, folder, df.schema, files_per_batch=1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        jobs.stream_ingest_dedup(stream, "id", "at", out, check)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert not reads  # what was seen is state, not output
    got = {r["id"]: r for r in plain(spark.read, f"{out}.parquet").collect()}
    assert len(got) == 90 and plain(spark.read, f"{out}.parquet").count() == 90
    for r in got.values():
        assert r["note"] == f"batch {r['id'] // 3}" and r["at"] == 1000 * (r["id"] // 3) - r["id"]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_days_and_months_are_utc(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for cast in ("timestamp", "timestamp_ntz"):
            clock = "timestamp_seconds(1706745600 + id * 3600)"  # from 2024-02-01 00:00 UTC on
            if cast == "timestamp_ntz":
                clock = f"convert_timezone(current_timezone(), 'UTC', CAST({clock} AS timestamp_ntz))"
            rows = spark.range(72).selectExpr(f"{clock} AS ts", "'a' AS label")
            folder, out, check = (work_folder(spark, n) for n in ("in", "out", "check"))
            rows.coalesce(1).write.parquet(folder)
            jobs.stream_trend(jobs.arriving(spark, folder, rows.schema), "ts", "label", out, check)
            assert [str(r["month"]) for r in jobs.latest(spark, out).collect()] == ["2024-02-01"]
            jobs.stream_daily_trend(jobs.arriving(spark, folder, rows.schema), "ts", "label", out + "d", check + "d")
            days = sorted((str(r["day"]), r["n"]) for r in spark.read.parquet(out + "d").collect())
            assert days == [("2024-02-01", 24), ("2024-02-02", 24)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_replayed_batch_replaces_its_output(spark):
    folder, out, check = (work_folder(spark, n) for n in ("in", "out", "check"))
    df = texts(spark, ROWS)
    df.coalesce(1).write.parquet(folder)
    for checkpoint in (check, check + "-lost"):  # the second run has lost its checkpoint
        jobs.stream_label_resume(jobs.arriving(spark, folder, df.schema), "id", "t", labeler, out, checkpoint)
    assert sorted(r["id"] for r in spark.read.parquet(f"{out}/labelled.parquet").collect()) == [1, 2, 5]
