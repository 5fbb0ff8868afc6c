"""First and last row per key.

The winner is found on slim rows (key and position only) with a partial aggregate on the map side,
so a key that holds a third of all rows shrinks to one row per task before anything is shuffled.
The wide rows are then fetched by their unique position, where no key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _position(order: list[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def first_positions(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The smallest position of each key, as the columns of ``order``; a NULL key has none."""
    winners = df.groupBy(key).agg(
        F.min(_position(order)).alias("_first"), F.count(key).alias("_known")
    )
    # The count is an aggregate, so this filter stays above it and no costly key is computed twice.
    winners = winners.filter(F.col("_known") > 0)
    return winners.select(
        F.col("_first").alias(order[0])
        if len(order) == 1
        else F.inline(F.array("_first")).alias(*order)
    )


def first_rows(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row with the smallest position of each key. ``order`` must identify a row."""
    return df.join(first_positions(df, key, order), order, "left_semi")


def merge_batches(df: DataFrame, key: str, position: str) -> DataFrame:
    """Last record of each id, at the place of its first one (``first_position``).

    ``position`` numbers the records across all batches. Records without an id are dropped.
    """
    known = df.filter(F.col(key).cast("string") != "")
    spans = known.groupBy(key).agg(
        F.max(position).alias(position), F.min(position).alias("first_position")
    )
    return known.join(spans.drop(key), position)


def union_batches(batches: list[DataFrame]) -> DataFrame:
    """All batches in one frame with a ``batch`` number; missing columns become NULL."""
    numbered = [b.withColumn("batch", F.lit(i)) for i, b in enumerate(batches)]
    merged = numbered[0]
    for batch in numbered[1:]:
        merged = merged.unionByName(batch, allowMissingColumns=True)
    return merged
