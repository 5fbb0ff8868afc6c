"""Reproducible splits, folds and samples.

Rows are ordered by a hash of their key, so the outcome depends on the data alone, not on files or
partitions. A split is a cut in that order per class. To find a cut no class is ever sorted as a
whole: a histogram of the hash's leading digits names the one bucket the cut falls into, only that
bucket's rows are ranked, and the value found there is compared with every row in a plain map.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commentlens import rules
from commentlens.session import written

BUCKET_DIGITS = 4  # 65,536 buckets per class


def hash_order(key: str, seed: int = rules.SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def class_sizes(df: DataFrame, label: str = "label") -> dict[str, int]:
    """Rows per allowed label, in label order."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().filter(F.col(label).isin(rules.LABELS)).collect()}
    return {x: counts[x] for x in rules.LABELS if x in counts}


def quotas(sizes: dict[str, int], draws: int) -> dict[str, int]:
    """``draws`` rows over the classes in proportion; left-overs to the largest fractions."""
    total = sum(sizes.values())
    exact = {c: n / total * draws for c, n in sizes.items()}
    parts = {c: math.floor(x) for c, x in exact.items()}
    by_fraction = sorted(sizes, key=lambda c: parts[c] - exact[c])
    for c in by_fraction[: draws - sum(parts.values())]:
        parts[c] += 1
    return parts


@dataclass
class Cuts:
    """Upper ends of consecutive parts per class, as values of the hash order."""

    ends: dict[str, list[tuple[str, object] | None]]

    def part(self, label: Column, order: Column, key: Column) -> Column:
        """Number of the part a row falls into."""
        number = F.lit(None).cast("int")
        for name, ends in self.ends.items():
            inside = F.lit(len(ends))
            for i in range(len(ends) - 1, -1, -1):
                if ends[i] is None:  # empty part
                    continue
                digest, last = ends[i]
                upto = (order < digest) | ((order == digest) & (key <= F.lit(last)))
                inside = F.when(upto, i).otherwise(inside)
            number = F.when(label == name, inside).otherwise(number)
        return number


def find_cuts(
    df: DataFrame, key: str, label: Column, ranks: dict[str, list[int]], seed: int = rules.SEED
) -> Cuts:
    """The rows at the given ranks (1-based, ascending) of each class in hash order."""
    rows = df.select(label.alias("c"), F.col(key).alias("k"), hash_order(key, seed).alias("h"))
    rows = rows.withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS))
    upto = Window.partitionBy("c").orderBy("bucket")
    histogram = (
        rows.groupBy("c", "bucket")
        .agg(F.count("*").alias("n"))
        .withColumn("end", F.sum("n").over(upto))
    )
    spark = df.sparkSession
    wanted = [(c, i, r) for c, rs in ranks.items() for i, r in enumerate(rs) if r > 0]
    ends = {c: [None] * len(rs) for c, rs in ranks.items()}
    if not wanted:
        return Cuts(ends)
    targets = F.broadcast(spark.createDataFrame(wanted, "c string, i int, r bigint"))
    start = F.col("end") - F.col("n")
    spots = histogram.join(targets, "c").filter((F.col("r") > start) & (F.col("r") <= F.col("end")))
    spots = spots.select("c", "bucket", "i", (F.col("r") - start).alias("place"))
    inside = Window.partitionBy("c", "bucket", "i").orderBy("h", "k")
    found = (
        rows.join(F.broadcast(spots), ["c", "bucket"])
        .withColumn("place_here", F.row_number().over(inside))
        .filter(F.col("place_here") == F.col("place"))
        .select("c", "i", "h", "k")
    )
    for r in found.collect():  # one row per class and part
        ends[r["c"]][r["i"]] = (r["h"], r["k"])
    return Cuts(ends)


def stratified_split(
    df: DataFrame, key: str, seed: int = rules.SEED
) -> tuple[DataFrame, dict[str, object]]:
    """``df`` with a ``split`` column (train / val / test), and a record of what was done."""
    df = df.filter(F.col("label").isin(rules.LABELS))
    sizes = class_sizes(df)
    n, smallest = sum(sizes.values()), min(sizes.values(), default=0)
    label = F.col("label")
    if n >= rules.MIN_ROWS_THREE_WAY and smallest >= rules.MIN_CLASS_THREE_WAY:
        held = math.ceil((rules.VALIDATION_SHARE + rules.TEST_SHARE) * n)
        test = math.ceil(rules.TEST_SHARE / (rules.VALIDATION_SHARE + rules.TEST_SHARE) * held)
        train = quotas(sizes, n - held)
        val = quotas({c: sizes[c] - train[c] for c in sizes}, held - test)
        strategy, names = "stratified_70_15_15", ["train", "val", "test"]
        ranks = {c: [train[c], train[c] + val[c]] for c in sizes}
        counts = (n - held, held - test, test)
    else:
        test = math.ceil(rules.FALLBACK_TEST_SHARE * n)
        strategy, names = "fallback_80_20", ["train", "test"]
        counts = (n - test, 0, test)
        if smallest >= 2 and min(n - test, test) >= len(sizes):
            train = quotas(sizes, n - test)
            ranks = {c: [train[c]] for c in sizes}
        else:  # too few members of a class: ignore the classes
            label = F.lit("")
            ranks = {"": [n - test]}
    cuts = find_cuts(df, key, label, ranks, seed)
    part = cuts.part(label, hash_order(key, seed), F.col(key))
    split = F.get(F.array(*[F.lit(x) for x in names]), part)
    info = {
        "strategy": strategy,
        "train_size": counts[0],
        "val_size": counts[1],
        "test_size": counts[2],
        "random_state": seed,
    }
    return df.withColumn("split", split), info


def fold_count(sizes: dict[str, int], most: int = 3) -> int:
    return max(2, min(most, min(sizes.values(), default=0)))


def stratified_folds(
    df: DataFrame, key: str, k: int | None = None, seed: int = rules.SEED
) -> DataFrame:
    """``df`` with a ``fold`` column (0 … k-1), each class spread evenly over the folds."""
    sizes = class_sizes(df)
    k = k or fold_count(sizes)
    ranks = {c: [(n // k) * i + min(i, n % k) for i in range(1, k)] for c, n in sizes.items()}
    cuts = find_cuts(df, key, F.col("label"), ranks, seed)
    return df.withColumn("fold", cuts.part(F.col("label"), hash_order(key, seed), F.col(key)))


def among_first(df: DataFrame, key: str, n: int, seed: int = rules.SEED) -> Column | None:
    """Whether a row is one of the first ``n`` in hash order; None if there are no more. Keys must be unique.

    The cut is a value found by histogram and compared in a map, so no task holds the ``n`` rows.
    """
    if df.count() <= n:
        return None
    everything = F.lit("")
    cuts = find_cuts(df, key, everything, {"": [n]}, seed)
    return cuts.part(everything, hash_order(key, seed), F.col(key)) == 0


def at_most(df: DataFrame, key: str, n: int, seed: int = rules.SEED) -> DataFrame:
    """All rows, or if there are more than ``n`` the first ``n`` in hash order. Keys must be unique."""
    if n < 1:
        return df.limit(0)
    inside = among_first(df, key, n, seed)
    return df if inside is None else df.filter(inside)


def first_by(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The ``n`` rows that come first by ``order``, which must identify a row; NULLs first.

    Only the columns of ``order`` are sorted, across the cluster. The sizes of the sorted partitions tell where the
    ``n``-th row lies, and its values are compared with every row in a map.
    """
    if n < 1:
        return df.limit(0)
    numbered = df.select(*order).orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    numbered = written(numbered, "order")
    part = F.shiftright("_at", 33)
    sizes = sorted(numbered.groupBy(part.alias("part")).count().collect())
    for row in sizes:
        if n <= row["count"]:
            break
        n -= row["count"]
    else:
        return df
    last = numbered.filter(F.col("_at") == (row["part"] << 33) + n - 1).first()
    kinds = [df.schema[c].dataType for c in order]
    end = F.struct(*[F.lit(last[c]).cast(kind).alias(c) for c, kind in zip(order, kinds)])
    return df.filter(F.struct(*order) <= end)


def review_sample(
    df: DataFrame, key: str, n: int = rules.REVIEW_ROWS, seed: int = rules.SEED
) -> DataFrame:
    """``n`` rows drawn by seed, in hash order, with an empty column for a human's label."""
    drawn = at_most(df, key, n, seed).orderBy(hash_order(key, seed), key)
    return drawn.withColumn("human_reviewed_label", F.lit(""))


def random_comment(df: DataFrame, key: str, seed: int = rules.SEED) -> DataFrame:
    return df.orderBy(hash_order(key, seed), key).limit(1)


def row_limit(df: DataFrame, order: str, n: int) -> DataFrame:
    """At most ``n`` rows, those with the smallest ``order``."""
    return first_by(df, [order], n)


def union_splits(df: DataFrame, *names: str) -> DataFrame:
    """The rows of several splits together, e.g. train and val before the refit."""
    return df.filter(F.col("split").isin(*names))
