"""Date rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentlens import rules
from commentlens.functions.text import col


def shift_api_date(c: Column | str, hours: int = rules.OVERLAP_HOURS) -> Column:
    """ISO-8601 UTC text, moved back by ``hours``, as ``yyyy-MM-dd HH:mm:ss``; NULL if unreadable."""
    seconds = F.split_part(F.regexp_replace(col(c), "Z\\z", ""), F.lit("."), F.lit(1))
    readable = F.when(seconds.rlike("^\\d{4}-\\d{1,2}-\\d{1,2}T\\d{1,2}:\\d{1,2}:\\d{1,2}$"), seconds)
    moment = readable.try_cast("timestamp_ntz")
    return F.date_format(moment - F.make_interval(hours=F.lit(hours)), "yyyy-MM-dd HH:mm:ss")


MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_CLOCK = r"(?:,?[ T]+(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\.\d+)?\s*([AaPp][Mm])?)?$"
# Written forms beside ISO, with the groups that hold year, month (number or name) and day.
_FORMS = [
    (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})", 1, 2, 3),
    (r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})", 3, 1, 2),
    (r"^([A-Za-z]{3,9})\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})", 3, 1, 2),
    (r"^(\d{1,2})(?:st|nd|rd|th)?[ -]([A-Za-z]{3,9})\.?,?[ -](\d{4})", 3, 2, 1),
    (r"^(\d{4})(\d{2})(\d{2})", 1, 2, 3),
]


def _written(text: Column, form: str, year: int, month: int, day: int) -> Column:
    """The moment a text of this form names, else NULL. Of two numbers the first is the month where that can be.

    All groups are taken in one pass over the text.
    """

    def moment(parts: Column) -> Column:
        def part(group: int) -> Column:
            return F.get(parts, group - 1)

        def number(value: Column) -> Column:
            return value.try_cast("int")

        name = F.lower(F.substring(part(month), 1, 3))
        month_value = F.coalesce(number(part(month)), F.nullif(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name).cast("int"), F.lit(0)))
        day_value = number(part(day))
        swapped = (month_value > 12) & (day_value <= 12)
        half = F.lower(part(7))
        hour = F.coalesce(number(part(4)), F.lit(0))
        hour = F.when(half == "pm", hour % 12 + 12).when(half == "am", hour % 12).otherwise(hour)
        return F.try_make_timestamp(
            number(part(year)),
            F.when(swapped, day_value).otherwise(month_value),
            F.when(swapped, month_value).otherwise(day_value),
            hour,
            F.coalesce(number(part(5)), F.lit(0)),
            F.coalesce(number(part(6)), F.lit(0)).cast("decimal(8,6)"),
        )

    groups = F.split(F.regexp_replace(text, form + _CLOCK, "$1|$2|$3|$4|$5|$6|$7"), "[|]")
    found = F.transform(F.array(groups), moment)
    return F.when(text.rlike(form + _CLOCK), F.get(found, 0))


def lenient_timestamp(c: Column | str) -> Column:
    """A date, timestamp or text column as timestamp; unreadable text becomes NULL.

    Beside ISO forms, texts like ``01/31/2024 5:30 PM``, ``31.01.2024``, ``Jan 31, 2024``, ``31 January 2024`` and
    ``20240131`` are read. Two numbers are month and day, or day and month if there is no such month.
    """
    text = F.btrim(col(c).cast("string"))
    iso = F.when(~text.rlike("^\\d{5,}"), col(c).try_cast("timestamp"))
    return F.coalesce(iso, *[_written(text, *form) for form in _FORMS])


def find_date_column(df: DataFrame) -> str | None:
    """The first well-known date column with at least one readable value.

    Names are compared without case, underscores and dots. One aggregate decides over all candidates present.
    """
    rank = {_folded(name): place for place, name in reversed(list(enumerate(rules.DATE_COLUMNS)))}
    present = sorted((rank[_folded(name)], i) for i, name in enumerate(df.columns) if _folded(name) in rank)
    if not present:
        return None
    values = [F.count(lenient_timestamp(F.col(f"`{df.columns[i]}`"))).alias(f"n{i}") for _, i in present]
    readable = df.agg(*values).first()
    return next((df.columns[i] for _, i in present if readable[f"n{i}"]), None)


def _folded(name: str) -> str:
    return name.translate(str.maketrans("", "", "_.")).lower()
