"""Records pulled page by page and landed as files: first sighting, filters, details."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.operators.keyed import first_rows
from commentlens.operators.sampling import first_by

def landed_pages_ingest(
    pages: DataFrame, key: str, order: list[str], limit: int | None = None
) -> DataFrame:
    """First sighting of each id in page order, up to ``limit`` records; rows without id go."""
    known = pages.filter(F.col(key).cast("string") != "")
    firsts = first_rows(known, key, order)
    return firsts if limit is None else first_by(firsts, order, limit)


def source_filter(
    df: DataFrame,
    docket: str | None = None,
    agency: str | None = None,
    term: str | None = None,
    posted_from: str | None = None,
    posted_to: str | None = None,
) -> DataFrame:
    """Only the conditions given. Dates are ``yyyy-MM-dd``, both ends included."""
    if docket:
        df = df.filter(F.col("docketId") == docket)
    if agency:
        df = df.filter(F.col("agencyId") == agency)
    if term:
        df = df.filter(F.lower("comment").contains(term.lower()))
    if posted_from:
        df = df.filter(F.substring("postedDate", 1, 10) >= posted_from)
    if posted_to:
        df = df.filter(F.substring("postedDate", 1, 10) <= posted_to)
    return df


def detail_or_header(headers: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """The detail record where there is one, else the header; both have the same columns."""
    fields = [c for c in headers.columns if c != key]
    detail = details.select(key, F.struct(*fields).alias("_detail"))
    header = headers.select(key, F.struct(*fields).alias("_header"))
    record = F.coalesce("_detail", "_header")
    return (
        header.join(detail, key, "left")
        .withColumn("_record", record)
        .select(key, "_record.*", F.col("_detail").isNotNull().alias("has_detail"))
    )


def text_body_count(records: DataFrame) -> DataFrame:
    return records.agg(F.count("*").alias("records"), F.count("comment").alias("with_text"))
