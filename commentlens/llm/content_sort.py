"""Exact dedup by content sort.

The rows are sorted by their normalised bytes across the cluster: splitters taken from a random sample
cut the order of (text, id) into as many ranges as there are partitions, one shuffle brings each range to
its partition, Spark's external sort puts equal texts next to each other, and the window over
(range, text) compares each row's whole text with its neighbour's.

A text that holds many rows meets several splitters. Those splitters carry the id as well, so the group
is dealt over several ranges; its smallest id and size are added up beforehand, one partial sum per task.
All other splitters are cut back to the shortest prefix that still separates them, so they are short.

Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from commentlens.llm.common import free_name, shuffle_partitions, text_or_empty

# Bounds of the sample that the splitters are taken from: rows, and bytes of text on average.
SAMPLE_PER_RANGE = 16
SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 64_000_000


def normalised(text: str) -> Column:
    """Each run of ASCII white space becomes one space; NULL is empty.

    The pattern meets only runs that change, which most texts hardly have.
    """
    return F.regexp_replace(text_or_empty(text), r"[\t-\r][\t-\r ]*| [\t-\r ]+", " ")


@dataclass(frozen=True)
class Splitter:
    """The first place of a range: all ids of ``text``, or only those from ``first_id`` on."""

    text: str
    first_id: Any = None


def choose_splitters(sample: list[tuple[str, Any]], ranges: int) -> list[Splitter]:
    """At most ``ranges - 1`` splitters, evenly spaced in the sample's order."""
    known = sorted({s for s in sample if s[1] is not None})
    places = sorted({i * len(known) // ranges for i in range(1, ranges)} - {0})
    found: list[Splitter] = []
    for n, place in enumerate(places):
        text, first_id = known[place]
        before = known[place - 1][0]
        if n and known[places[n - 1]][0] == text:
            cut = Splitter(text, first_id)
        elif text == before or n + 1 < len(places) and known[places[n + 1]][0] == text:
            cut = Splitter(text)
        else:
            same = next((k for k, (a, b) in enumerate(zip(before, text)) if a != b), len(before))
            cut = Splitter(text[: same + 1])
        if cut != Splitter(""):
            found.append(cut)
    return found


def _range_of(norm: Column, key: Column, splitters: list[Splitter], kind: DataType) -> Column:
    """How many splitters stand at or before the row, by binary search in a constant array."""
    if not splitters:
        return F.lit(0)
    texts = F.array(*[F.lit(s.text) for s in splitters])
    ids = F.array(*[F.lit(s.first_id).cast(kind) for s in splitters])
    steps = [1 << b for b in reversed(range(len(splitters).bit_length()))]

    def advance(at: Column, step: Column) -> Column:
        place = at + step
        text, first = F.get(texts, place - 1), F.get(ids, place - 1)
        reached = (norm > text) | ((norm == text) & (first.isNull() | key.isNull() | (key >= first)))
        return F.when((place <= len(splitters)) & reached, place).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def _sorted(
    docs: DataFrame, text: str, key: str, keep: list[str], ranges: int | None
) -> tuple[DataFrame, dict[str, Column]]:
    """The rows in sorted order with ``keep``, and the columns that tell each row's lot."""
    kind = docs.schema[key].dataType
    ranges = ranges or shuffle_partitions(docs)
    slim = docs.select(F.col(key).alias("key"), normalised(text).alias("norm"))

    rows, volume = docs.select(F.count(F.lit(1)), F.sum(F.octet_length(text_or_empty(text)))).first()
    want = min(SAMPLE_PER_RANGE * ranges, SAMPLE_ROWS, SAMPLE_BYTES * rows / max(volume or 0, 1))
    sample = slim.sample(min(1.0, want / max(rows, 1)), seed=7).collect()
    splitters = choose_splitters([(r["norm"], r["key"]) for r in sample], ranges)

    cut_texts = sorted({s.text for s in splitters if s.first_id is not None})
    cut = F.array(*[F.lit(t) for t in cut_texts])
    sums: dict[int, tuple[Any, int]] = {}
    if cut_texts:
        shared = slim.select("key", F.array_position(cut, F.col("norm")).alias("number")).filter("number > 0")
        totals = shared.groupBy("number").agg(F.min("key").alias("low"), F.count(F.lit(1)).alias("n"))
        sums = {r["number"]: (r["low"], r["n"]) for r in totals.collect()}

    taken = [*docs.columns, "keep_id", "group_size", "kept", "text_sha256"]
    norm, place, at, copies, low, own = (
        free_name(n, taken) for n in ("norm", "range", "at_copy", "copies", "low", "own_key")
    )
    # Where the text travels too, the normalised one does only if it differs.
    with_text = text in keep
    carried = docs.select(*keep, F.col(key).alias(own), normalised(text).alias(norm))
    carried = carried.withColumn(place, _range_of(F.col(norm), F.col(own), splitters, kind))
    if with_text:
        carried = carried.withColumn(norm, F.when(~F.col(norm).eqNullSafe(F.col(text)), F.col(norm)))
    dealt = carried.repartitionById(len(splitters) + 1, F.col(place))
    if with_text:
        dealt = dealt.withColumn(norm, F.coalesce(F.col(norm), F.col(text)))
    group = Window.partitionBy(place, norm)
    marked = dealt.withColumns(
        {
            at: F.row_number().over(group.orderBy(F.col(own).asc_nulls_last())),
            copies: F.count(F.lit(1)).over(group),
            low: F.min(own).over(group),
        }
    )
    if sums:
        found = F.array_position(cut, F.col(norm)).cast("int")
        lows = F.array(*[F.lit(sums[i + 1][0]).cast(kind) for i in range(len(cut_texts))])
        sizes = F.array(*[F.lit(sums[i + 1][1]).cast("long") for i in range(len(cut_texts))])
        marked = marked.withColumns(
            {
                low: F.when(found > 0, F.get(lows, found - 1)).otherwise(F.col(low)),
                copies: F.when(found > 0, F.get(sizes, found - 1)).otherwise(F.col(copies)),
            }
        )
    return marked, {
        "keep_id": F.col(low),
        "group_size": F.col(copies).cast("long"),
        "kept": (F.col(at) == 1) & F.col(own).eqNullSafe(F.col(low)),
        "text_sha256": F.sha2(F.col(norm), 256),
    }


def sort_by_content(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    keep: list[str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Every row with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` (of the normalised text).

    Of equal texts the row with the smallest key is kept, exactly one if the key repeats. A NULL text is
    empty. A NULL key ranks last: such a row is kept only in a group without any key, where ``keep_id``
    is NULL. ``keep``: columns carried along (all if not given); of these, one that has the name of a
    result column is replaced. An empty table gives an empty result.
    """
    keep = list(docs.columns if keep is None else keep)
    marked, results = _sorted(docs, text, key, keep, ranges)
    plain = [F.col(c) for c in keep if c.lower() not in results]
    return marked.select(*plain, *[v.alias(k) for k, v in results.items()])


def drop_exact_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", ranges: int | None = None) -> DataFrame:
    """The rows that stay, with their own columns."""
    marked, results = _sorted(docs, text, key, docs.columns, ranges)
    return marked.filter(results["kept"]).select(*docs.columns)
