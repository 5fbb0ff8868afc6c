"""Profiles of raw and labelled comments.

Texts never leave the scan: each row is reduced to hash, label and lengths, and copies are combined
on the map side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commentlens import rules
from commentlens.functions.labels import label_key, label_valid
from commentlens.functions.text import (
    comment_hash,
    comment_kind,
    normalize_text,
    null_or_empty,
    soften_entities,
    strip,
    words_in,
)

QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9}


def invalid_label_counts(df: DataFrame) -> DataFrame:
    """Rows per label value outside the label set; missing labels count as ``nan``."""
    return (
        df.filter(~label_valid("label"))
        .groupBy(label_key("label").alias("label"))
        .agg(F.count("*").alias("rows"))
    )


def _slim(df: DataFrame, order: str, action: str) -> DataFrame:
    """One row per (text, label): how often, where first, how long.

    Rows that do not take part in the search for copies have a NULL ``text_key``.
    """
    rows = df.select(
        order,
        label_key("label").alias("label"),
        "comment",
        (~label_valid("label")).alias("invalid"),
        null_or_empty("comment").alias("blank"),
        normalize_text("comment").alias("norm"),
    )
    included = F.lit(True) if action == "flag" else ~F.col("invalid")
    usable = included & ~F.col("blank")
    return (
        rows.select(
            order,
            "label",
            "invalid",
            (included & F.col("blank")).alias("blank"),
            F.when(usable, F.unhex(comment_hash("comment"))).alias("text_key"),
            null_or_empty("norm").alias("emptied"),
            F.length("norm").alias("chars"),
            words_in("norm").alias("words"),
        )
        .groupBy("text_key", "label")
        .agg(
            F.count("*").alias("n"),
            F.count_if("invalid").alias("invalid"),
            F.count_if("blank").alias("blank"),
            F.min(order).alias("first"),
            F.max("emptied").alias("emptied"),
            F.max("chars").alias("chars"),
            F.max("words").alias("words"),
        )
    )


def _distinct_texts(slim: DataFrame) -> DataFrame:
    """One row per text with the label of its first occurrence; one more for the other rows.

    The label is carried as its number, so that the aggregate's buffer has a fixed width and stays a hash aggregate.
    """
    found = slim.groupBy("text_key").agg(
        F.sum("n").alias("n"),
        F.sum("invalid").alias("invalid"),
        F.sum("blank").alias("blank"),
        F.count("*").alias("pairs"),
        F.min(F.struct("first", _label_number("label").alias("number"))).alias("first"),
        F.max("emptied").alias("emptied"),
        F.max("chars").alias("chars"),
        F.max("words").alias("words"),
    )
    return found.withColumn("label", F.get(F.array(*[F.lit(x) for x in rules.LABELS]), F.col("first.number")))


def _label_number(label: str) -> Column:
    """Place in the label list; NULL for other labels, which no report tells apart here."""
    place = F.array_position(F.array(*[F.lit(x) for x in rules.LABELS]), F.col(label))
    return F.nullif(place, F.lit(0)).cast("int") - 1


def dup_counts(df: DataFrame, order: str) -> DataFrame:
    """Rows beyond the first of each text, and of each (text, label)."""
    rows = df.select(order, "label", F.unhex(comment_hash("comment")).alias("text_key"))
    pairs = rows.groupBy("text_key", "label").agg(F.count("*").alias("n"))
    texts = pairs.groupBy("text_key").agg(F.sum("n").alias("n"), F.count("*").alias("pairs"))
    return texts.agg(
        (F.sum("n") - F.count("*")).alias("exact_duplicate_comment_count"),
        (F.sum("n") - F.sum("pairs")).alias("duplicate_comment_and_label_count"),
    )


def length_profile(df: DataFrame, normalized: str) -> DataFrame:
    """Lengths in characters and words of normalised texts; zeros for no rows."""
    sizes = df.select(F.length(normalized).alias("chars"), words_in(normalized).alias("words"))
    return sizes.agg(*_length_columns(F.lit(True)))


def _length_columns(included) -> list:
    def of(name):
        return F.when(included, F.col(name))

    zero = F.lit(0.0)
    shares = F.array(*[F.lit(q) for q in QUARTILES.values()])
    found = F.percentile(of("chars"), shares)
    columns = [
        F.coalesce(F.min(of("chars")), F.lit(0)).alias("chars_min"),
        F.coalesce(F.max(of("chars")), F.lit(0)).alias("chars_max"),
        F.coalesce(F.avg(of("chars")), zero).alias("chars_mean"),
    ]
    columns += [
        F.coalesce(F.get(found, i), zero).alias(f"chars_{name}") for i, name in enumerate(QUARTILES)
    ]
    return columns + [
        F.coalesce(F.min(of("words")), F.lit(0)).alias("words_min"),
        F.coalesce(F.max(of("words")), F.lit(0)).alias("words_max"),
        F.coalesce(F.avg(of("words")), zero).alias("words_mean"),
        F.coalesce(F.percentile(of("words"), 0.5), zero).alias("words_median"),
    ]


SKETCH_K = 800  # size of a quantile sketch: some tens of kilobytes, whatever the number of rows
RANK_ERROR = 0.01  # of a quantile from a sketch of that size; about three times the error that 99 of 100 estimates keep


def length_sketches(df: DataFrame, normalized: str, by: list[str] = ()) -> DataFrame:
    """Lengths of normalised texts as mergeable sketches, one row per group of ``by``: rows, extremes and quantiles (KLL).

    The exact profile keeps a count of every different length until the end; a sketch has a fixed size, so tasks send
    kilobytes, and parts sketched on different days can be merged without their rows.
    """
    sizes = df.select(*by, F.length(normalized).cast("bigint").alias("chars"), words_in(normalized).cast("bigint").alias("words"))
    parts = [
        f(name).alias(f"{name}_{x}") for name in ("chars", "words")
        for x, f in (("min", F.min), ("max", F.max), ("sketch", lambda c: F.kll_sketch_agg_bigint(c, F.lit(SKETCH_K))))
    ]
    return sizes.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *parts)


def merge_length_sketches(sketches: DataFrame, by: list[str] = ()) -> DataFrame:
    """Sketches of parts as sketches of coarser groups, or of all."""
    parts = [
        f(f"{name}_{x}").alias(f"{name}_{x}") for name in ("chars", "words")
        for x, f in (("min", F.min), ("max", F.max), ("sketch", lambda c: F.kll_merge_agg_bigint(c, F.lit(SKETCH_K))))
    ]
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), *parts)


def length_estimates(sketches: DataFrame, by: list[str] = ()) -> DataFrame:
    """``(…, measure, share, estimate, rows, least, most)``: quartiles whose rank is within ``RANK_ERROR`` of the share."""
    entries = [
        F.struct(
            F.lit(name).alias("measure"), F.lit(q).alias("share"),
            F.kll_sketch_get_quantile_bigint(f"{name}_sketch", F.lit(q)).alias("estimate"),
            "rows", F.col(f"{name}_min").alias("least"), F.col(f"{name}_max").alias("most"),
        )
        for name in ("chars", "words") for q in QUARTILES.values()
    ]
    return sketches.filter("rows > 0").select(*by, F.inline(F.array(*entries)))


def label_distribution(df: DataFrame) -> DataFrame:
    """Count and percentage per allowed label, in the fixed order, zeros included."""
    counts = [F.count_if(F.col("label") == label).alias(label) for label in rules.LABELS]
    total = df.agg(F.count("*").alias("_total"), *counts)
    share = F.when(
        F.col("_total") > 0, F.round(F.lit(100.0) * F.col("count") / F.col("_total"), 2)
    ).otherwise(F.lit(0.0))
    return total.select(
        "_total",
        F.posexplode(
            F.array(*[F.struct(F.lit(x).alias("label"), F.col(x).alias("count")) for x in rules.LABELS])
        ).alias("position", "_row"),
    ).select("position", "_total", "_row.*").select(
        "position", "label", "count", share.alias("percentage")
    )


def cleaned_label_distribution(df: DataFrame, order: str) -> DataFrame:
    """The label distribution that cleaning would leave, without moving a single text."""
    texts = _distinct_texts(_slim(df, order, "remove"))
    kept = F.col("text_key").isNotNull() & ~F.col("emptied")
    return label_distribution(texts.withColumn("label", F.when(kept, F.col("label"))).filter("label IS NOT NULL"))


def imbalance_ratio(df: DataFrame) -> DataFrame:
    """Largest over smallest class that occurs, and whether that calls for a warning."""
    counts = [F.count_if(F.col("label") == label).alias(label) for label in rules.LABELS]
    present = [F.nullif(F.col(label), F.lit(0)) for label in rules.LABELS]
    ratio = F.greatest(*present) / F.least(*present)
    return df.agg(*counts).select(
        F.round(ratio, 2).alias("class_imbalance_ratio"),
        (ratio >= rules.IMBALANCE_RATIO).alias("imbalanced"),
    )


def quality_report(df: DataFrame, order: str, action: str = "remove") -> DataFrame:
    """Everything the cleaning of a labelled set found, in one row."""
    texts = _distinct_texts(_slim(df, order, action))
    usable = F.col("text_key").isNotNull()
    kept = usable & ~F.col("emptied")
    short = (F.col("chars") < rules.SHORT_CHARS) | (F.col("words") < rules.SHORT_WORDS)
    found = texts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("original_size"),
        F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid_label_count"),
        F.coalesce(F.sum("blank"), F.lit(0)).alias("empty_or_null_comments_removed"),
        F.coalesce(F.sum(F.when(usable, F.col("n"))), F.lit(0)).alias(
            "size_before_duplicate_removal"
        ),
        F.coalesce(F.sum(F.when(usable, F.col("n") - 1)), F.lit(0)).alias(
            "exact_duplicate_comment_count"
        ),
        F.coalesce(F.sum(F.when(usable, F.col("n") - F.col("pairs"))), F.lit(0)).alias(
            "duplicate_comment_and_label_count"
        ),
        F.count_if(usable & F.col("emptied")).alias("empty_after_normalization_removed"),
        F.count_if(kept & short).alias("short_comments_flagged"),
        F.count_if(kept).alias("final_size"),
        *[F.count_if(kept & (F.col("label") == x)).alias(f"count_{x}") for x in rules.LABELS],
        *_length_columns(kept),
    )
    total = F.col("final_size")
    shares = [
        F.when(total > 0, F.round(F.lit(100.0) * F.col(f"count_{x}") / total, 2))
        .otherwise(F.lit(0.0))
        .alias(f"percentage_{x}")
        for x in rules.LABELS
    ]
    present = [F.nullif(F.col(f"count_{x}"), F.lit(0)) for x in rules.LABELS]
    ratio = F.greatest(*present) / F.least(*present)
    report = found.select(
        "*",
        F.col("exact_duplicate_comment_count").alias("duplicates_removed"),
        *shares,
        F.round(ratio, 2).alias("class_imbalance_ratio"),
    )
    outcome = {"remove": "removed", "flag": "flagged"}[action]
    invalid = F.format_string(
        f"%d rows had labels outside {rules.LABELS} and were {outcome}.", "invalid_label_count"
    )
    brief = F.format_string(
        f"%d comments are shorter than {rules.SHORT_WORDS} words / {rules.SHORT_CHARS} chars "
        "and were flagged (not removed).",
        "short_comments_flagged",
    )
    skewed = F.format_string("Class imbalance: majority:minority ratio = %.2f.", ratio)
    warnings = F.array(
        F.when(F.col("invalid_label_count") > 0, invalid),
        F.when(F.col("short_comments_flagged") > 0, brief),
        F.when(ratio >= rules.IMBALANCE_RATIO, skewed),
    )
    return report.withColumn("warnings", F.array_compact(warnings))


def tall(report: DataFrame) -> DataFrame:
    """A one-row report as ``(metric, value)`` rows; each warning is a row of its own."""
    numbers = [c for c in report.columns if c != "warnings"]
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in numbers]
    if "warnings" in report.columns:
        notes = F.transform(
            "warnings",
            lambda w: F.struct(F.concat(F.lit("warning: "), w).alias("metric"), F.lit(1.0).alias("value")),
        )
        return report.select(F.inline(F.concat(F.array(*pairs), notes)))
    return report.select(F.inline(F.array(*pairs)))


def report_lines(report: DataFrame) -> DataFrame:
    """A one-row report as text for a reader: ``(line, text)``."""
    numbers = [c for c in report.columns if c != "warnings"]
    lines = [F.format_string("%-40s %s", F.lit(f"{c}:"), F.col(c).cast("string")) for c in numbers]
    text = F.array(*lines)
    if "warnings" in report.columns:
        text = F.concat(text, F.transform("warnings", lambda w: F.concat(F.lit("- "), w)))
    return report.select(F.posexplode(text).alias("line", "text"))


def kind_report(df: DataFrame) -> DataFrame:
    """Count and percentage (one decimal) of substantive, attachment and empty comments."""
    kinds = ["substantive", "attachment", "null_or_empty"]
    kind = df.select(comment_kind("comment").alias("kind"))
    counts = kind.agg(
        F.count("*").alias("_total"), *[F.count_if(F.col("kind") == k).alias(k) for k in kinds]
    )
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("count")) for k in kinds])
    return counts.select("_total", F.inline(rows)).select(
        "kind", "count", F.round(F.lit(100.0) * F.col("count") / F.col("_total"), 1).alias("percentage")
    )


def first_samples(df: DataFrame, order: str, n: int = rules.SAMPLE_TEXTS) -> DataFrame:
    """The first substantive texts, softened and cut for display."""
    rows = df.filter(comment_kind("comment") == "substantive").orderBy(order).limit(n)
    text = strip(soften_entities("comment"))
    cut = F.concat(F.substring(text, 1, rules.SAMPLE_CHARS), F.lit("..."))
    sample = F.when(F.length(text) > rules.SAMPLE_CHARS, cut).otherwise(text)
    return rows.select(order, sample.alias("sample"))


def stage_status(spark: SparkSession, stages: dict[str, DataFrame | None]) -> DataFrame:
    """Row count of each stage's output; NULL for a stage that has none."""
    counts = None
    for name, df in stages.items():
        if df is None:
            one = spark.range(1).select(F.lit(name).alias("stage"), F.lit(None).cast("bigint").alias("rows"))
        else:
            one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def pipeline_status(spark: SparkSession, stages: dict[str, DataFrame | None], report: dict | None) -> DataFrame:
    """:func:`stage_status`, and a row for the model with its name and accuracy, NULL when none was trained."""
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("model", "string"), ("accuracy", "double"))]
    found = report or {}
    model = spark.createDataFrame(
        [("model", None, found.get("model_type"), found.get("accuracy"))],
        "stage string, rows bigint, model string, accuracy double",
    )
    return stage_status(spark, stages).select("*", *none).unionByName(model)
