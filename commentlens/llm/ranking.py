"""Positions of rows within their group, in an order, without a window over a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commentlens.llm.common import free_name, shuffle_partitions
from commentlens.session import written

_ROW_BITS = 33  # of monotonically_increasing_id: the row's number in its partition


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str], position: str, size: str) -> DataFrame:
    """``rows`` with ``position`` (a long, from 0, within the group in ascending ``order``) and the group's ``size``.

    One range shuffle sorts by (group, order), so a group of any size is dealt over many tasks. A row's place in its
    partition is its number there; the group's rows of earlier partitions are added from a table with one row
    per (partition, group). Rows alike in group and order follow each other in any order. NULLs come first.
    """
    index, part, first, before = (free_name(n, [*rows.columns, position, size]) for n in ("index", "part", "first", "before"))
    by = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    dealt = rows.repartitionByRange(shuffle_partitions(rows), *by).sortWithinPartitions(*by)
    dealt = written(dealt.withColumn(index, F.monotonically_increasing_id()), "ranked")
    number = F.col(index).bitwiseAND((1 << _ROW_BITS) - 1)
    placed = dealt.withColumns({part: F.shiftright(index, _ROW_BITS), index: number})
    held = placed.groupBy(part, *group).agg(F.min(index).alias(first), F.count(F.lit(1)).alias(size))
    whole = Window.partitionBy(*group)
    held = held.withColumns(
        {
            before: F.coalesce(F.sum(size).over(whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            size: F.sum(size).over(whole),
        }
    )
    names = {c: free_name(f"{c}_of", [*rows.columns, position, size, index, part, first, before]) for c in group}
    held = held.select(F.col(part).alias(f"{part}_of"), *[F.col(c).alias(n) for c, n in names.items()], first, before, size)
    same = F.col(part) == F.col(f"{part}_of")
    for c, n in names.items():
        same &= F.col(c).eqNullSafe(F.col(n))
    joined = placed.join(held, same)
    return joined.select(*rows.columns, (F.col(index) - F.col(first) + F.col(before)).alias(position), size)
