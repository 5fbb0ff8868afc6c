"""Session defaults and the shared work folder."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Skewed groups are split at run time; small join sides are broadcast only when their size, as
# measured after the shuffle, is below the threshold.
SCALE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("commentlens")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SCALE_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder the session names in ``spark.checkpoint.dir``; gone when the session's JVM ends.

    Without that setting a local master uses its warehouse folder; a cluster must name a folder that every
    executor can reach.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def written(df: DataFrame, purpose: str, even: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and readable after executor loss.

    ``even`` lets AQE merge small and split large partitions first, for data that is read again
    and again, as in training.
    """
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    (df.hint("rebalance") if even else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def one_task_each(tables: list[DataFrame], function: Callable, schema: str, purpose: str) -> DataFrame:
    """``mapInArrow`` over written tables, each read by a task of its own, with its ``number``; nothing is shuffled. The outcome
    is written."""
    conf, name = tables[0].sparkSession.conf, "spark.sql.unionOutputPartitioning"  # would read them all in one task
    read = [t.coalesce(1).select(F.lit(i).alias("number"), "*") for i, t in enumerate(tables)]
    before = conf.get(name, None)
    conf.set(name, "false")
    try:
        return written(functools.reduce(DataFrame.unionAll, read).mapInArrow(function, schema), purpose)
    finally:
        if before is None:
            conf.unset(name)
        else:
            conf.set(name, before)
