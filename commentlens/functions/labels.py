"""Label rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commentlens import rules
from commentlens.functions.text import col, strip


def label_key(c: Column | str) -> Column:
    """The label as reported: stripped, and ``nan`` where it is missing."""
    return F.coalesce(strip(c), F.lit("nan"))


def label_valid(c: Column | str) -> Column:
    return label_key(c).isin(rules.LABELS)


def label_rank(c: Column | str) -> Column:
    """Position in the fixed label order."""
    return F.array_position(F.lit(rules.LABELS), col(c)).cast("int") - 1


def parse_label(c: Column | str) -> Column:
    """The label in a labeler's free-form answer; NULL unless it names exactly one."""
    answer = strip(F.regexp_replace(col(c), "(?isu)" + rules.THINK_PATTERN, ""))
    answer = strip(F.replace(answer, F.lit("```"), F.lit("")))
    answer = F.btrim(F.btrim(answer, F.lit('"')), F.lit("'"))
    mention = "(?iuU)\\b(" + "|".join(rules.LABELS) + ")\\b"
    mentions = F.regexp_extract_all(answer, F.lit(mention), F.lit(1))
    label = F.initcap(F.get(mentions, 0))
    return F.when((F.size(mentions) == 1) & label.isin(rules.LABELS), label)
