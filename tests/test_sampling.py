"""Splits, folds and samples."""

import hashlib

import pytest
from pyspark.sql import functions as F

from commentlens.operators import sampling


def labelled(spark, sizes):
    names = ["Negative", "Neutral", "Positive"]
    rows = [(i, names[c]) for i, c in enumerate(c for c, n in enumerate(sizes) for _ in range(n))]
    return spark.createDataFrame(rows, "id bigint, label string")


def counts(split):
    return {(r["split"], r["label"]): r["count"] for r in split.groupBy("split", "label").count().collect()}


def test_quotas_of_a_three_way_split(spark):
    split, info = sampling.stratified_split(labelled(spark, (602, 177, 83)), "id")
    assert info == {"strategy": "stratified_70_15_15", "train_size": 603, "val_size": 129, "test_size": 130, "random_state": 42}
    got = counts(split)
    expected = {"train": (421, 124, 58), "val": (90, 26, 13), "test": (91, 27, 12)}
    for part, sizes in expected.items():
        assert tuple(got[part, x] for x in ("Negative", "Neutral", "Positive")) == sizes


@pytest.mark.parametrize("sizes,strategy", [((40, 30, 9), "two-way"), ((20, 10, 1), "plain")])
def test_small_tables_split_two_ways(spark, sizes, strategy):
    split, info = sampling.stratified_split(labelled(spark, sizes), "id")
    n = sum(sizes)
    assert info["strategy"] == "fallback_80_20" and info["val_size"] == 0
    parts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert parts == {"train": info["train_size"], "test": info["test_size"]} and sum(parts.values()) == n
    if strategy == "two-way":
        assert counts(split)["test", "Positive"] == 2


def test_split_is_the_ranking_by_hash(spark):
    """Cuts found through the histogram equal a full sort, whatever the partitions."""
    df = labelled(spark, (300, 100, 50))
    split, _ = sampling.stratified_split(df, "id")
    again, _ = sampling.stratified_split(df.repartition(13), "id")
    assert sorted(split.collect()) == sorted(again.collect())
    rows = split.withColumn("h", sampling.hash_order("id")).orderBy("label", "h").collect()
    for label in ("Negative", "Neutral", "Positive"):
        parts = [r["split"] for r in rows if r["label"] == label]
        assert parts == sorted(parts, key=["train", "val", "test"].index)


def test_cuts_within_one_bucket(spark, monkeypatch):
    """With a single bucket the ranking inside it does all the work; the outcome is the same."""
    df = labelled(spark, (200, 60, 20))
    expected = sorted(sampling.stratified_split(df, "id")[0].collect())
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", 0)
    assert sorted(sampling.stratified_split(df, "id")[0].collect()) == expected


def test_folds_are_even(spark):
    folds = sampling.stratified_folds(labelled(spark, (31, 10, 5)), "id")
    got = {(r["label"], r["fold"]): r["count"] for r in folds.groupBy("label", "fold").count().collect()}
    assert [got["Negative", f] for f in range(3)] == [11, 10, 10]
    assert [got["Positive", f] for f in range(3)] == [2, 2, 1]
    assert sampling.fold_count({"a": 1}) == 2 and sampling.fold_count({"a": 9}) == 3


def test_samples_repeat(spark):
    df = labelled(spark, (30, 20, 10))
    first, second = (sampling.review_sample(d, "id", 7).collect() for d in (df, df.repartition(5)))
    assert first == second and len(first) == 7 and first[0]["human_reviewed_label"] == ""
    assert sampling.review_sample(df, "id", 500).count() == 60
    assert sampling.random_comment(df, "id").count() == 1
    assert sampling.row_limit(df, "id", -1).count() == 0


def test_other_labels_are_left_out(spark):
    df = labelled(spark, (40, 30, 20)).withColumn("label", F.when(F.col("id") == 0, "Mixed").otherwise(F.col("label")))
    split, info = sampling.stratified_split(df, "id")
    assert split.count() == 89 == info["train_size"] + info["test_size"]


@pytest.mark.parametrize("n", [0, 1, 7, 99, 100, 101, 500])
def test_first_rows_by_a_cut(spark, n):
    rows = [(i * 37 % 100 // 10, f"k{i * 37 % 100:03d}", i) for i in range(100)]
    df = spark.createDataFrame(rows, "a int, b string, v int").repartition(5)
    got = sorted(tuple(r) for r in sampling.first_by(df, ["a", "b"], n).collect())
    assert got == sorted(rows)[:n]
    plan = sampling.first_by(df, ["a", "b"], n)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan


def test_nulls_come_first(spark):
    df = spark.createDataFrame([(None, 1), (3, 2), (2, 3), (1, 4)], "k int, v int")
    assert sorted(r["v"] for r in sampling.row_limit(df, "k", 2).collect()) == [1, 4]


@pytest.mark.parametrize("n", [0, 3, 60, 61])
def test_at_most_is_a_cut_in_hash_order(spark, n):
    df = spark.range(60).withColumnRenamed("id", "k")
    got = sorted(r["k"] for r in sampling.at_most(df, "k", n).collect())
    order = sorted(range(60), key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())
    assert got == sorted(order[:n])
