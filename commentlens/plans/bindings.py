"""The test tables as the inputs the operators expect, in Spark and in SQL.

The documents hold no faults of the kinds the rules look for, so some rows get one, chosen by their
id; every row of the table takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table, read as it lies."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


LABEL = "CASE WHEN toxic = 1 THEN 'Negative' WHEN quality = 1 THEN 'Positive' ELSE 'Neutral' END"

# Both engines read this SQL.
LABELLED = f"""
SELECT d.doc_id, d.text AS comment, {LABEL} AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""

MESSY = f"""
SELECT d.doc_id,
  CASE WHEN d.doc_id % 29 = 3 THEN NULL WHEN d.doc_id % 29 = 5 THEN '  '
       WHEN d.doc_id % 29 = 7 THEN '...' WHEN d.doc_id % 29 = 11 THEN 'Bad rule'
       WHEN d.doc_id % 29 = 13 THEN ' N/A ' ELSE d.text END AS comment,
  CASE WHEN l.doc_id IS NOT NULL THEN {LABEL}
       WHEN d.doc_id % 5 = 0 THEN NULL WHEN d.doc_id % 5 = 1 THEN 'Mixed'
       WHEN d.doc_id % 5 = 2 THEN 'positive' ELSE ' Neutral ' END AS label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

RAW = """
SELECT doc_id AS ord, concat('C-', CAST(doc_id AS VARCHAR(20))) AS id,
  CASE WHEN doc_id % 31 = 3 THEN NULL WHEN doc_id % 31 = 5 THEN '  '
       WHEN doc_id % 31 = 7 THEN 'See attached file(s)'
       WHEN doc_id % 31 = 11 THEN concat('<p>', text, '</p> &amp; &lt;b&gt;')
       WHEN doc_id % 31 = 13 THEN concat('  ', text)
       WHEN doc_id % 31 = 17 THEN 'I submit my letter as a pdf' ELSE text END AS comment,
  lang AS agencyId,
  CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS docketId,
  concat('D-', source) AS commentOnDocumentId,
  concat('2024-', lpad(CAST(doc_id % 12 + 1 AS VARCHAR(20)), 2, '0'), '-',
         lpad(CAST(doc_id % 28 + 1 AS VARCHAR(20)), 2, '0'), 'T',
         lpad(CAST(doc_id % 24 AS VARCHAR(20)), 2, '0'), ':30:00',
         CASE WHEN doc_id % 2 = 0 THEN 'Z' ELSE '.125Z' END) AS postedDate
FROM documents"""

# A rule in place of a model, so that metrics have an exact answer.
PREDICTED = f"""
SELECT d.doc_id, {LABEL} AS label, d.source, d.lang,
  CASE WHEN d.lang = 'en' THEN 'Positive' WHEN d.n_chars < 500 THEN 'Neutral'
       ELSE 'Negative' END AS predicted
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""

# Five payload shapes, nested up to four levels deep.
PAYLOAD = """CASE doc_id % 6
  WHEN 0 THEN to_json(named_struct('data', array(named_struct('id', doc_id, 'attributes', named_struct('comment', text)))))
  WHEN 1 THEN to_json(named_struct('comments', array(named_struct('comment_text', text), named_struct('comment_text', lang))))
  WHEN 2 THEN concat('[', to_json(named_struct('body', text)), ',[[[[', to_json(named_struct('content', source)), ']]]]]')
  WHEN 3 THEN to_json(named_struct('id', doc_id, 'text', concat(' ', text, ' ')))
  WHEN 4 THEN concat('["', lang, '", null, {"comment": "  ", "body": "', source, '"}]')
  ELSE concat('{"data": 5, "comment": ', doc_id, ', "content": "', source, '"}') END AS payload"""


def _view(spark: SparkSession, sf: str, sql: str, *names: str) -> DataFrame:
    return spark.sql(
        sql.replace("documents", "{documents}").replace("labels", "{labels}"),
        **{n: table(spark, sf, n) for n in names},
    )


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, sf, LABELLED, "documents", "labels")


def messy(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, sf, MESSY, "documents", "labels")


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    """Flat raw fields; see :func:`nested` for the API's own shape."""
    return _view(spark, sf, RAW, "documents")


def nested(raw: DataFrame) -> DataFrame:
    fields = ["comment", "agencyId", "docketId", "commentOnDocumentId", "postedDate"]
    return raw.select("ord", "id", F.struct(*fields).alias("attributes"))


def predicted(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, sf, PREDICTED, "documents", "labels")


def payloads(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").selectExpr("doc_id", PAYLOAD)


# ------------------------------------------------------------------ SQL parts (DuckDB)

WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def sql_norm(x: str) -> str:
    no_control = rf"regexp_replace({x}, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', ' ', 'g')"
    visible = f"replace(replace({no_control}, chr(65279), ''), chr(8203), '')"
    return sql_strip(f"regexp_replace({visible}, '{WS}+', ' ', 'g')")


def sql_empty(x: str) -> str:
    filler = r"""^([\s\p{Z}\x0b\x1c-\x1f]|[-._=+*#~^`''"|\\/,;:!?()\[\]{}<>])*$"""
    return (
        f"({x} IS NULL OR lower({sql_strip(x)}) IN ('nan', 'none', 'null', 'n/a', 'na') "
        f"OR regexp_matches({x}, '{filler}'))"
    )


def sql_words(x: str) -> str:
    """Number of white-space separated words."""
    return rf"len(regexp_extract_all({x}, '[^\s\x0b\x1c-\x1f\p{{Z}}]+'))"


def sql_unescape(x: str) -> str:
    for name, char in [("lt", "'<'"), ("gt", "'>'"), ("quot", "'\"'"), ("copy", "'©'"), ("middot", "'·'")]:
        x = f"replace({x}, '&{name};', {char})"
    return f"replace({x}, '&amp;', '&')"


def sql_clean_html(x: str) -> str:
    x = sql_unescape(x)
    x = rf"regexp_replace({x}, '<br\s*/?>', chr(10), 'gi')"
    x = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    x = rf"regexp_replace({x}, '[ \t]+', ' ', 'g')"
    x = rf"regexp_replace({x}, '\n{{3,}}', chr(10) || chr(10), 'g')"
    return sql_strip(x)


def sql_in(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)
