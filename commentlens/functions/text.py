"""Text rules as column expressions.

All of them run inside the JVM. Two steps have no Spark function (resolving every HTML entity,
NFKC); they are Arrow UDFs that receive NULL for each row a plain expression can already decide:
ASCII text is NFKC as it stands, and the usual entities are replaced in the JVM.
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentlens import rules

# Entities resolved by plain replacement; a text with any other "&" goes through html.unescape.
# "amp" is last, so that "&amp;lt;" becomes "&lt;" and no more.
COMMON_ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "#39": "'", "nbsp": "\xa0", "copy": "\xa9",
    "middot": "\xb7", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”",
    "ndash": "–", "mdash": "—", "amp": "&",
}


@F.pandas_udf(T.StringType())
def _unescape_any(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


@F.pandas_udf(T.StringType())
def _nfkc_any(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with costly columns added, so that later filters use them instead of repeating them.

    Catalyst moves a filter on a computed column below the computation by writing it out again;
    it does not do so across a generator.
    """
    replaced = [c for c in df.columns if c not in columns]
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*[F.col(f"`{c}`") for c in replaced], F.inline(F.array(values)))


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(rules.SPACE_CHARS))


def is_blank(c: Column | str) -> Column:
    c = col(c)
    return c.isNull() | (strip(c) == "")


def null_or_empty(c: Column | str) -> Column:
    """Missing, blank, a word that stands for missing, or nothing but punctuation."""
    c = col(c)
    only_filler = F.btrim(c, F.lit(rules.SPACE_CHARS + rules.MEANINGLESS_CHARS)) == ""
    return c.isNull() | only_filler | F.lower(strip(c)).isin(rules.EMPTY_MARKERS)


def unescape(c: Column | str) -> Column:
    c = col(c)
    plain = c
    for name, char in COMMON_ENTITIES.items():
        plain = F.replace(plain, F.lit(f"&{name};"), F.lit(char))
    uncommon = c.rlike("&(?!(" + "|".join(COMMON_ENTITIES) + ");)")
    return F.when(uncommon, _unescape_any(F.when(uncommon, c))).otherwise(plain)


def nfkc(c: Column | str) -> Column:
    c = col(c)
    beyond_ascii = F.octet_length(c) != F.length(c)
    return F.when(beyond_ascii, _nfkc_any(F.when(beyond_ascii, c))).otherwise(c)


def clean_html_text(c: Column | str) -> Column:
    """Entities first, so that an escaped tag is removed like any other tag."""
    text = unescape(c)
    text = F.regexp_replace(text, "(?iU)" + rules.BR_TAG_PATTERN, "\n")
    text = F.regexp_replace(text, rules.TAG_PATTERN, " ")
    text = F.regexp_replace(text, "[ \\t]+", " ")
    text = F.regexp_replace(text, "\\n{3,}", "\n\n")
    return strip(text)


def squeeze(c: Column | str) -> Column:
    """``normalize_text`` for text known to be NFKC already."""
    blanked = rules.CONTROL_CHARS + "".join(
        ch for ch in rules.SPACE_CHARS if ch not in rules.CONTROL_CHARS and ch != " "
    )
    text = F.translate(col(c), blanked + rules.INVISIBLE_CHARS, " " * len(blanked))
    return F.btrim(F.regexp_replace(text, " {2,}", " "))


def normalize_text(c: Column | str) -> Column:
    """The one normalisation used for training and for scoring; NULL becomes empty text."""
    return squeeze(nfkc(F.coalesce(col(c), F.lit(""))))


def words_in(normalized: Column | str) -> Column:
    """Number of words of already normalised text."""
    text = col(normalized)
    spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(text == "", 0).otherwise(spaces + 1)


def word_count(c: Column | str) -> Column:
    return words_in(normalize_text(c))


def space_separated_words(c: Column | str) -> Column:
    """Number of white-space separated words of any text."""
    return F.regexp_count(col(c), F.lit("(?U)[^\\s\\x1c-\\x1f]+"))


def placeholder_only(c: Column | str) -> Column:
    """A bare pointer to an attachment. ``(?d)``: the dot stops at line feeds only."""
    c = col(c)
    pattern = "(?iuUd)" + rules.PLACEHOLDER_PATTERN
    # The anchored pattern fails at the first character of most texts; the words are counted after.
    return strip(c).rlike(pattern) & (space_separated_words(c) <= rules.PLACEHOLDER_MAX_WORDS)


def short_flag(normalized: Column | str) -> Column:
    text = col(normalized)
    return (F.length(text) < rules.SHORT_CHARS) | (words_in(text) < rules.SHORT_WORDS)


def comment_kind(c: Column | str) -> Column:
    """Empty, pointing to an attachment, or substantive. Blank text counts as substantive."""
    c = col(c)
    lowered = F.lower(c)
    mentions = F.lit(False)
    for keyword in rules.ATTACHMENT_KEYWORDS:
        mentions = mentions | lowered.contains(keyword)
    return (
        F.when(c.isNull() | (c == ""), "null_or_empty")
        .when(mentions, "attachment")
        .otherwise("substantive")
    )


def soften_entities(c: Column | str) -> Column:
    text = F.replace(col(c), F.lit("<br/>"), F.lit("\n"))
    text = F.replace(text, F.lit("&rsquo;"), F.lit("'"))
    return F.replace(text, F.lit("&mdash;"), F.lit("—"))


def comment_hash(c: Column | str) -> Column:
    return F.sha2(col(c), 256)
