"""Cleaning raw records and labelled comments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentlens import rules
from commentlens.functions.labels import label_key, label_valid
from commentlens.functions.text import (
    clean_html_text,
    comment_hash,
    computed_once,
    normalize_text,
    null_or_empty,
    placeholder_only,
    short_flag,
    strip,
)
from commentlens.operators.keyed import first_positions, first_rows


def docket_fallback(docket: str, document: str) -> Column:
    """The docket, or the document commented on; empty text counts as missing."""
    return F.coalesce(F.nullif(F.col(docket), F.lit("")), F.col(document))


def flatten_raw(df: DataFrame) -> DataFrame:
    """Raw API records as flat rows; every other column is kept."""
    others = [c for c in df.columns if c != "attributes"]
    return df.select(
        *others,
        F.col("attributes.comment").alias("comment"),
        F.col("attributes.agencyId").alias("agencyId"),
        docket_fallback("attributes.docketId", "attributes.commentOnDocumentId").alias("docketId"),
        F.col("attributes.postedDate").alias("postedDate"),
    )


def tag_raw(df: DataFrame) -> DataFrame:
    """Cleaned text, the reason to drop a row, and the key that finds copies.

    ``reason`` is NULL for rows that stay or fall only as copies; ``text_key`` is NULL for the rest.
    """
    cleaned = computed_once(df, comment=clean_html_text("comment"))
    reason = F.when(F.col("comment").isNull() | (F.col("comment") == ""), "null_or_empty").when(
        placeholder_only("comment"), "placeholder"
    )
    tagged = computed_once(cleaned, reason=reason, comment=F.col("comment"))
    key = F.unhex(comment_hash(strip(F.lower("comment"))))
    return tagged.withColumn("text_key", F.when(F.col("reason").isNull(), key))


def dedup_normalized(df: DataFrame, text: str, order: str) -> DataFrame:
    """First row of each text, ignoring case and outer white space."""
    keyed = df.withColumn("text_key", F.unhex(comment_hash(strip(F.lower(text)))))
    return first_rows(keyed, "text_key", [order]).drop("text_key")


def dedup_exact(df: DataFrame, text: str, order: str) -> DataFrame:
    """First row of each text as it stands; texts equal only after cleaning all stay."""
    keyed = df.withColumn("text_key", F.unhex(comment_hash(text)))
    return first_rows(keyed, "text_key", [order]).drop("text_key")


def clean_raw(df: DataFrame, order: str) -> DataFrame:
    """Usable, distinct raw comments. Only rows that stay are cleaned a second time."""
    firsts = first_positions(tag_raw(df), "text_key", [order])
    kept = df.join(firsts, order, "left_semi")
    return kept.withColumn("comment", clean_html_text("comment"))


def raw_clean_report(df: DataFrame) -> DataFrame:
    """Five counters that add up: total = null/empty + placeholder + duplicate + kept."""
    counts = tag_raw(df).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("reason") == "null_or_empty").alias("null_or_empty"),
        F.count_if(F.col("reason") == "placeholder").alias("placeholder_only"),
        F.count("text_key").alias("_usable"),
        F.countDistinct("text_key").alias("kept"),
    )
    duplicates = F.col("_usable") - F.col("kept")
    return counts.select(
        "total", "null_or_empty", "placeholder_only", duplicates.alias("exact_duplicate"), "kept"
    )


def check_labels(df: DataFrame, action: str = "remove") -> DataFrame:
    """Label stripped; rows outside the label set removed, or flagged and kept."""
    if action not in ("remove", "flag"):
        raise ValueError("action must be 'remove' or 'flag'")
    df = df.withColumn("label", label_key("label"))
    valid = label_valid("label")
    return df.filter(valid) if action == "remove" else df.withColumn("label_flagged_invalid", ~valid)


def validate_and_clean(df: DataFrame, order: str, action: str = "remove") -> DataFrame:
    """Labelled comments made fit for training.

    The order of steps matters: labels, empty texts, exact copies, normalisation, texts emptied by
    it, short texts (flagged, kept). All columns but ``comment`` and ``label`` are dropped.
    """
    rows = check_labels(df.select(order, "comment", "label"), action)
    rows = rows.filter(~null_or_empty("comment"))
    rows = dedup_exact(rows, "comment", order)
    rows = rows.withColumn("original_comment", F.col("comment"))
    rows = computed_once(rows, comment=normalize_text("comment"))
    rows = rows.filter(~null_or_empty("comment"))
    return rows.withColumn("is_short_comment", short_flag("comment"))


def drop_unusable(df: DataFrame) -> DataFrame:
    """Rows fit for training or evaluation: both fields present, label allowed."""
    return df.dropna(subset=["comment", "label"]).filter(F.col("label").isin(rules.LABELS))
