"""Incremental forms of ingest, scoring, trend and labelling.

Each job reads what has arrived, and stops (``availableNow``); run again it takes up what is new.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentlens import rules
from commentlens.operators.labeling import Labeler, hashed, label_batch
from commentlens.operators.scoring import predict_batch


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"  # state on the executors' disks


def arriving(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Files landed in ``folder``; what is there when a job starts is one batch.

    Smaller batches suit the jobs without a watermark. With one, they need files that arrive in the
    order of time, since rows far behind the newest one seen are late.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _run(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _run_keyed(spark: SparkSession, writer, checkpoint: str) -> None:
    """As :func:`_run`, for jobs that remember every key: in RocksDB, with changes alone written per batch."""
    wanted = {STATE_STORE: ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        _run(writer, checkpoint)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def stream_ingest_dedup(stream: DataFrame, key: str, time: str, out: str, checkpoint: str) -> None:
    """First sighting of each id, however late a repetition or a new id arrives.

    Which ids were seen, and when, is keyed state in the checkpoint: a batch looks up its own ids and reads no earlier output,
    so its cost follows from its own rows. Within a batch the earliest row by ``time`` stays. A replayed batch has the
    time it had before and replaces what it wrote. Rows without an id are dropped. A clock that goes back between two
    batches of a run is an error, as state could no longer tell which sighting was first.
    """
    spark = stream.sparkSession
    arrived, row = "_arrived", "_row"
    columns = F.struct(F.col(time), *[c for c in stream.columns if c != time])
    known = stream.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.struct(F.current_timestamp().alias(arrived), columns.alias(row)).alias("_seen"))
    firsts = known.groupBy("_key").agg(F.min("_seen").alias("_first")).select("_first.*", F.current_timestamp().alias("_now"))
    latest_run = []

    def step(batch: DataFrame, number: int) -> None:
        fresh = batch.filter(F.col(arrived) == F.col("_now"))
        now = fresh.select("_now").first()
        if now is not None:
            if latest_run and now["_now"] <= latest_run[-1]:
                raise RuntimeError("the clock went back between two batches")
            latest_run[:] = [now["_now"]]
        _replace(fresh.select(f"{row}.*").select(*stream.columns), f"{out}.parquet", number)

    _run_keyed(spark, firsts.writeStream.outputMode("update").foreachBatch(step), checkpoint)


def _replace(rows: DataFrame, path: str, number: int) -> None:
    """Write a batch's rows; a batch that is written again replaces its own folder only."""
    writer = rows.withColumn("batch", F.lit(number).cast("bigint")).write
    writer.partitionBy("batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def stream_score(
    stream: DataFrame, model: PipelineModel, column: str, out: str, checkpoint: str
) -> None:
    """Sentiment of each arriving comment; stateless."""
    scored = predict_batch(stream, model, column)
    _run(scored.writeStream.format("parquet").option("path", out), checkpoint)


def stream_trend(stream: DataFrame, time: str, label: str, out: str, checkpoint: str) -> None:
    """Counts per calendar month (UTC) and label, kept complete; the state is one row per month and label.

    Each batch writes a folder of its own and then an empty one that says it is whole; :func:`latest` reads the newest
    whole one. So readers always find a result, also while the next one is written or after a crash.
    """
    month = F.date_trunc("month", _utc(stream, time)).cast("date")
    counts = stream.select(month.alias("month"), F.col(label).alias("label")).groupBy("month", "label")

    def add(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{number:012d}")

    writer = counts.agg(F.count("*").alias("n")).writeStream.outputMode("complete")
    _run(writer.foreachBatch(add), checkpoint)


def latest(spark: SparkSession, out: str) -> DataFrame:
    """The newest whole result of a job that writes one folder per batch."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/*/_SUCCESS")
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop) or []
    if not len(found):
        raise FileNotFoundError(f"no result below {out} yet")
    return spark.read.parquet(max(s.getPath().getParent().toString() for s in found))


def _utc(stream: DataFrame, time: str) -> Column:
    """The wall clock in UTC. Timestamps without a zone are taken as UTC, whatever the session's zone."""
    if isinstance(stream.schema[time].dataType, T.TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(time).cast("timestamp_ntz"))
    return F.col(time).cast("timestamp_ntz")


def stream_daily_trend(
    stream: DataFrame, time: str, label: str, out: str, checkpoint: str, hours: int = rules.OVERLAP_HOURS
) -> None:
    """Counts per day (UTC) and label, each day written once it is closed; later rows are not counted.

    Windows start at UTC midnight; their start is read as seconds, so the session's zone has no say.
    """
    moment = F.col(time)
    if not isinstance(stream.schema[time].dataType, T.TimestampType):
        # The cast reads the clock in the session's zone; the UTC clock is what is meant.
        moment = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(time).cast("timestamp_ntz")).cast("timestamp")
    timed = stream.withColumn("_t", moment).withWatermark("_t", f"{hours} hours")
    counts = timed.groupBy(F.window("_t", "1 day"), F.col(label).alias("label")).agg(F.count("*").alias("n"))
    day = F.date_from_unix_date((F.unix_seconds("window.start") / 86400).cast("int"))
    days = counts.select(day.alias("day"), "label", "n")
    _run(days.writeStream.format("parquet").option("path", out), checkpoint)


def stream_label_resume(
    stream: DataFrame, key: str, text: str, labeler: Labeler, folder: str, checkpoint: str
) -> None:
    """Label arriving comments once each: what was labelled is a key and a text, which keyed state remembers.

    A batch reads no earlier output. Every micro-batch writes folders of its own, so replaying one after a failure replaces its
    output instead of repeating it.
    """
    fresh = hashed(stream, key, text).dropDuplicates([key, "text_sha"])

    def step(batch: DataFrame, number: int) -> None:
        for name, part in zip(("labelled", "failed"), label_batch(batch, key, labeler)):
            _replace(part, f"{folder}/{name}.parquet", number)

    _run_keyed(stream.sparkSession, fresh.writeStream.foreachBatch(step), checkpoint)
