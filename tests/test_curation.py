"""Cleaning, profiles and counters on small tables with planted faults."""

import pytest
from pyspark.sql import functions as F

from commentlens.operators import curate, keyed, quality

SCHEMA = "id bigint, comment string, label string"


def test_clean_and_report(spark, comments):
    df = spark.createDataFrame(comments, SCHEMA)
    clean = curate.validate_and_clean(df, "id")
    report = quality.quality_report(df, "id").first()
    assert (report["original_size"], report["invalid_label_count"]) == (39, 1)
    assert report["empty_or_null_comments_removed"] == 4
    assert report["duplicates_removed"] == report["duplicate_comment_and_label_count"] == 1
    assert report["final_size"] == clean.count() == 33
    assert [report[f"count_{x}"] for x in ("Positive", "Negative", "Neutral")] == [15, 11, 7]
    assert report["class_imbalance_ratio"] == 2.14
    assert report["warnings"] == ["1 rows had labels outside ['Positive', 'Negative', 'Neutral'] and were removed."]
    lines = [r["text"] for r in quality.report_lines(quality.quality_report(df, "id")).orderBy("line").collect()]
    assert lines[0].split() == ["original_size:", "39"] and lines[-1].startswith("- 1 rows had labels")
    texts = [r["comment"] for r in clean.collect()]
    assert len(texts) == 33 and len(set(texts)) == 32  # equal only after cleaning: both stay


def test_flag_mode_keeps_invalid_labels(spark, comments):
    df = spark.createDataFrame(comments, SCHEMA)
    flagged = curate.validate_and_clean(df, "id", "flag")
    assert flagged.filter("label_flagged_invalid").count() == 1
    report = quality.quality_report(df, "id", "flag").first()
    assert report["final_size"] == 34
    assert report["percentage_Positive"] == round(100 * 15 / 34, 2)
    with pytest.raises(ValueError):
        curate.check_labels(df, "other")


def test_result_does_not_depend_on_partitions(spark, comments):
    df = spark.createDataFrame(comments, SCHEMA)
    one, many = (sorted(curate.validate_and_clean(df.repartition(n), "id").collect()) for n in (1, 7))
    assert one == many


def test_dedup(spark):
    df = spark.createDataFrame([(1, "A"), (2, "A"), (3, "A "), (4, "a"), (5, " a")], "id bigint, t string")
    assert sorted(r["id"] for r in curate.dedup_exact(df, "t", "id").collect()) == [1, 3, 4, 5]
    assert [r["id"] for r in curate.dedup_normalized(df, "t", "id").collect()] == [1]


def test_hot_text_is_one_row(spark):
    """A third of the rows are one text; the copies are combined before the shuffle."""
    df = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("t"))
    kept = curate.dedup_exact(df, "t", "id")
    assert kept.count() == 20001 and kept.filter("t = 'same'").first()["id"] == 0


def test_merge_batches(spark):
    df = spark.createDataFrame([(0, "a", 1), (1, "b", 1), (2, "a", 2), (3, None, 9), (4, "", 9)], "pos bigint, id string, v int")
    rows = keyed.merge_batches(df, "id", "pos").orderBy("first_position").collect()
    assert [(r["id"], r["v"], r["first_position"]) for r in rows] == [("a", 2, 0), ("b", 1, 1)]


def test_raw_counters_add_up(spark):
    texts = [None, "  ", "<br/>", "See attached file(s)", "Fine &amp; good", "fine & GOOD ", "Other"]
    df = spark.createDataFrame(
        [(i, f"r{i}", (t, "AG", "" if i % 2 else "D", "DOC", "2024-01-01T00:00:00Z")) for i, t in enumerate(texts)] + [(9, "r9", None)],
        "ord bigint, id string, attributes struct<comment: string, agencyId: string, docketId: string, commentOnDocumentId: string, postedDate: string>",
    )
    flat = curate.flatten_raw(df)
    report = curate.raw_clean_report(flat).first()
    assert tuple(report) == (8, 4, 1, 1, 2)
    assert report["total"] == report["null_or_empty"] + report["placeholder_only"] + report["exact_duplicate"] + report["kept"]
    kept = curate.clean_raw(flat, "ord").orderBy("ord").collect()
    assert [(r["comment"], r["docketId"]) for r in kept] == [("Fine & good", "D"), ("Other", "D")]


def test_profiles_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    report = quality.quality_report(none, "id").first()
    assert report["final_size"] == 0 and report["chars_max"] == 0 and report["chars_p90"] == 0.0
    assert report["class_imbalance_ratio"] is None and report["warnings"] == []
    assert [r["percentage"] for r in quality.label_distribution(none).collect()] == [0.0] * 3


def test_length_percentiles(spark):
    df = spark.createDataFrame([("x" * n,) for n in (1, 2, 3, 4, 10)], "t string")
    row = quality.length_profile(df, "t").first()
    assert row["chars_p90"] == pytest.approx(7.6) and row["chars_median"] == 3 and row["words_max"] == 1


def test_first_samples_are_cut(spark):
    df = spark.createDataFrame([(1, "a" * 250), (2, "see pdf"), (3, " b<br/>c ")], "id bigint, comment string")
    rows = [r["sample"] for r in quality.first_samples(df, "id").collect()]
    assert rows == ["a" * 200 + "...", "b\nc"]
