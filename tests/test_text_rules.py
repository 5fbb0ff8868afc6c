"""Scalar rules on literal cases."""

import html
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from commentlens import rules
from commentlens.functions import dates, labels, text, tokens


def apply(spark, fn, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in rows.select("i", fn("v")).orderBy("i").collect()]


CASES = [
    (text.null_or_empty, [(None, True), ("", True), ("  ", True), ("NaN", True), (" n/a ", True), ("...", True),
                          ("?!", True), ("no", False), ("ok.", False), ("@", False), ("\x1f ", True)]),
    (text.is_blank, [(None, True), (" \t ", True), ("...", False)]),
    (text.normalize_text, [("ﬁne  rule", "fine rule"), ("a\u0007b", "a b"), ("﻿a​b", "ab"),
                           ("Not GOOD!", "Not GOOD!"), (None, ""), ("a  \n b ", "a b"), ("é", "é"),
                           ("…", "...")]),
    (text.clean_html_text, [("a<br/>b", "a\nb"), ("&lt;b&gt;x", "x"), ("a&amp;lt;b", "a&lt;b"), ("a\n\n\n\nb", "a\n\nb"),
                            ("x&hearts;y", "x♥y"), ("&ampx", "&x"), ("a<BR >b", "a\nb"), (None, None)]),
    (text.placeholder_only, [("See attached file(s)", True), ("Please find attachment", True), ("See attachedness", False),
                             ("I see attached", False), ("see attached " + "w " * 14, False),
                             ("see attached\nfile", False), ("find attached file", True)]),
    (text.comment_kind, [(None, "null_or_empty"), ("", "null_or_empty"), ("  ", "substantive"), ("I SUBMIT this", "attachment")]),
    (text.short_flag, [("Bad rule", True), ("Terrible awful rule", False), ("a b c", True)]),
    (text.word_count, [("", 0), (None, 0), (" one\ttwo \n three", 3)]),
    (text.comment_hash, [("abc", "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad")]),
    (text.soften_entities, [("a<br/>b&rsquo;s&mdash;c", "a\nb's—c")]),
    (labels.parse_label, [("<think>Positive?</think> Negative", "Negative"), ("'neutral'", "Neutral"),
                          ("It is positive.", "Positive"), ("Positive or Negative", None), ("Positive, positive", None),
                          ("", None), (None, None), ("```\nNEGATIVE\n```", "Negative"), ("nonpositive", None)]),
    (labels.label_valid, [(" Positive ", True), ("positive", False), ("Mixed", False), (None, False)]),
    (labels.label_key, [(None, "nan"), (" x ", "x")]),
    (dates.shift_api_date, [("2024-01-02T10:00:00.123Z", "2024-01-02 04:00:00"), ("2024-01-02T03:00:00Z", "2024-01-01 21:00:00"),
                            ("x", None), ("", None), (None, None), ("2024-13-02T10:00:00Z", None)]),
    (tokens.tokenize_words, [("The Rule isn't FAIR, unfair!", ["fair", "unfair"]), ("it's ok", [])]),
    (tokens.keyword_words, [("Tax-rate of a tax", ["tax", "rate"])]),
    (tokens.tokenize_tfidf, [("A good, Good été", ["good", "good", "été", "good good", "good été"]),
                             ("one", ["one"]), ("", [])]),
]


@pytest.mark.parametrize("fn,cases", CASES, ids=[fn.__name__ for fn, _ in CASES])
def test_literal_cases(spark, fn, cases):
    assert apply(spark, fn, [c[0] for c in cases]) == [c[1] for c in cases]


def test_space_characters_are_pythons():
    assert set(rules.SPACE_CHARS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.characters(min_codepoint=1, exclude_categories=["Cs"]), max_size=40), min_size=20, max_size=60))
def test_normalisation_and_unescaping_match_python(spark, texts):
    def normalized(t):
        t = unicodedata.normalize("NFKC", t)
        t = "".join(" " if (ord(c) < 32 and c not in "\t\n\r") or ord(c) == 127 else c for c in t)
        return " ".join(t.replace("﻿", "").replace("​", "").split())

    assert apply(spark, text.normalize_text, texts) == [normalized(t) for t in texts]
    odd = [f"{t}&amp;&lt;{t}&copy;" for t in texts] + [f"&{t};&#{i};&notit;&amp" for i, t in enumerate(texts)]
    assert apply(spark, text.unescape, odd) == [html.unescape(t) for t in odd]


def test_term_counts(spark):
    got = apply(spark, lambda v: tokens.term_counts(tokens.tokenize_tfidf(v)), ["b b ab ab ab", ""])
    assert {tuple(r) for r in got[0]} == {("ab", 3), ("ab ab", 2)} and got[1] == []


def test_find_date_column(spark):
    frame = spark.createDataFrame([("x", "2024-01-02"), ("y", None)], "date string, Posted_Date string")
    assert dates.find_date_column(frame) == "Posted_Date"
    assert dates.find_date_column(frame.select("date")) is None
    assert dates.find_date_column(frame.select(F.col("date").alias("other"))) is None
    dotted = frame.select(F.col("Posted_Date").alias("attributes.postedDate"))
    assert dates.find_date_column(dotted) == "attributes.postedDate"


@pytest.mark.parametrize(
    "text,moment",
    [
        ("2024-01-31", "2024-01-31 00:00:00"),
        ("2024-01-31T05:06:07", "2024-01-31 05:06:07"),
        ("01/02/2024", "2024-01-02 00:00:00"),
        ("31/01/2024", "2024-01-31 00:00:00"),
        ("1/31/2024 5:30 PM", "2024-01-31 17:30:00"),
        ("31.01.2024 05:30", "2024-01-31 05:30:00"),
        ("Jan 5, 2024", "2024-01-05 00:00:00"),
        ("January 5th 2024 12:15 am", "2024-01-05 00:15:00"),
        ("5 March 2024", "2024-03-05 00:00:00"),
        ("2024/1/5", "2024-01-05 00:00:00"),
        ("20240105", "2024-01-05 00:00:00"),
        ("Feb 30, 2024", None),
        ("13/13/2024", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_lenient_dates(spark, text, moment):
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(dates.lenient_timestamp("d").cast("string")).first()[0] == moment
