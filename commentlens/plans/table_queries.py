"""Sources, cleaning, profiles, joins, windows and reports over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentlens import rules
from commentlens.functions import text
from commentlens.operators import curate, dialog, features, insights, keyed, metrics, quality, sampling
from commentlens.operators.labeling import hashed, resume_anti_join, resume_mismatch
from commentlens.plans import bindings as b
from commentlens.plans.registry import query
from commentlens.session import work_folder
from commentlens.sources import envelopes, landed, readers, writers

# ------------------------------------------------------------------------- sources and sinks


@query(
    "read_comments",
    f"""SELECT doc_id, CASE WHEN comment NOT IN ({b.sql_in(rules.CSV_NULLS)}) THEN comment END AS comment, label
        FROM (SELECT doc_id, comment, trim(label) AS label FROM ({b.MESSY}) m)""",
)
def read_comments(spark, sf):
    path = work_folder(spark, "messy") + ".csv"
    stripped = b.messy(spark, sf).withColumn("label", text.strip("label"))
    writers.write_table(stripped, path)
    rows = readers.read_comments(spark, path, "doc_id bigint, comment string, label string", multiline=True)
    return rows.select("doc_id", "comment", "label")


@query(
    "load_valid_texts",
    f"SELECT {b.sql_strip('text')} AS comment FROM documents WHERE {b.sql_strip('text')} <> ''",
)
def load_valid_texts(spark, sf):
    path = work_folder(spark, "landed") + ".json"
    record = F.struct("doc_id", F.struct(F.col("text").alias("comment")).alias("attributes"))
    writers.write_table(b.table(spark, sf, "documents").select(record.alias("r")).select("r.*"), path)
    return readers.load_valid_texts(spark, path)


@query(
    "load_prior_output",
    f"SELECT comment, label FROM ({b.LABELLED}) l",
)
def load_prior_output(spark, sf):
    path = work_folder(spark, "labelled") + ".csv"
    writers.write_table(b.labelled(spark, sf).select("comment", "label"), path)
    earlier = readers.load_prior_output(spark, path, multiline=True)
    return earlier.unionByName(readers.load_prior_output(spark, path + ".missing.csv"))


@query("resolve_columns", f"SELECT doc_id, comment, label FROM ({b.LABELLED}) l")
def resolve_columns(spark, sf):
    odd = b.labelled(spark, sf).withColumnsRenamed({"comment": " Text ", "label": "Sentiment"})
    return readers.resolve_columns(odd)


RECORDS_SQL = """
SELECT doc_id, 0 AS record_pos, text AS content, doc_id % 6 AS shape FROM documents WHERE doc_id % 6 IN (0, 1, 2, 3)
UNION ALL SELECT doc_id, 1, lang, 1 FROM documents WHERE doc_id % 6 = 1
UNION ALL SELECT doc_id, 1, source, 2 FROM documents WHERE doc_id % 6 = 2
UNION ALL SELECT doc_id, 0, lang, 4 FROM documents WHERE doc_id % 6 = 4
UNION ALL SELECT doc_id, 1, source, 4 FROM documents WHERE doc_id % 6 = 4
UNION ALL SELECT doc_id, 0, source, 5 FROM documents WHERE doc_id % 6 = 5"""


# Broken payloads beside the table's: text behind a value, lines of an indented list, no value at all.
BROKEN = ['{"text": "x"} {"text": "y"}', '"id": "a",', '{', '["text"],', '1, 2', '[1], [2', '']


def _with_broken(spark, sf):
    rows = [(-1 - i, p) for i, p in enumerate(BROKEN)] + [(-100, '[{"text": " kept "}]')]
    return b.payloads(spark, sf).unionByName(spark.createDataFrame(rows, "doc_id bigint, payload string"))


@query(
    "json_records",
    f"""SELECT doc_id, CAST(record_pos AS BIGINT) AS record_pos, shape = 4 AND record_pos = 0 AS is_string,
        CASE WHEN shape IN (0, 3) THEN doc_id END AS id FROM ({RECORDS_SQL}) r
        UNION ALL SELECT -1 - unnest(range({len(BROKEN)})), 0, NULL, NULL UNION ALL SELECT -100, 0, false, NULL""",
)
def json_records(spark, sf):
    records = envelopes.json_records(_with_broken(spark, sf), "payload")
    return records.select(
        "doc_id",
        F.col("record_pos").cast("bigint").alias("record_pos"),
        (F.schema_of_variant("record") == "STRING").alias("is_string"),
        F.try_variant_get("record", "$.id", "bigint").alias("id"),
    )


@query(
    "json_text",
    f"""SELECT doc_id, CAST(record_pos AS BIGINT) AS record_pos, {b.sql_strip('content')} AS comment
        FROM ({RECORDS_SQL}) r WHERE {b.sql_strip('content')} <> '' UNION ALL SELECT -100, 0, 'kept'""",
)
def json_text(spark, sf):
    records = envelopes.json_records(_with_broken(spark, sf), "payload")
    found = records.select(
        "doc_id", F.col("record_pos").cast("bigint").alias("record_pos"), envelopes.json_text("record").alias("comment")
    )
    return found.filter(F.col("comment").isNotNull())


@query(
    "merge_batches",
    """SELECT user_id, min(event_id) AS first_position, max(event_id) AS event_id,
       arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
       FROM events GROUP BY user_id""",
)
def merge_batches(spark, sf):
    events = b.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return keyed.merge_batches(events, "user_id", "event_id")


@query(
    "union_batches",
    """SELECT event_id, user_id, value, CAST(0 AS INTEGER) AS batch FROM events WHERE ts < TIMESTAMP '2024-01-15'
       UNION ALL SELECT event_id, user_id, NULL, 1 FROM events WHERE ts >= TIMESTAMP '2024-01-15'""",
)
def union_batches(spark, sf):
    events = b.table(spark, sf, "events")
    early = events.filter("ts < timestamp_ntz'2024-01-15'").select("event_id", "user_id", "value")
    late = events.filter("ts >= timestamp_ntz'2024-01-15'").select("event_id", "user_id")
    return keyed.union_batches([early, late])


@query("write_table", f"SELECT doc_id, comment, label FROM ({b.LABELLED}) l")
def write_table(spark, sf):
    path = work_folder(spark, "out") + ".json"
    writers.write_table(b.labelled(spark, sf), path)
    return spark.read.schema("doc_id bigint, comment string, label string").json(path)


@query(
    "first_existing_path",
    "SELECT 'b.csv' AS found, count(*) AS records FROM documents",
)
def first_existing_path(spark, sf):
    folder = work_folder(spark, "candidates")
    ids = b.table(spark, sf, "documents").select("doc_id", "lang")
    for name in ("c.csv", "b.csv"):
        writers.write_table(ids, f"{folder}/{name}")
    path = readers.first_existing_path(spark, [f"{folder}/a.parquet"], folder)
    found = readers.read_comments(spark, path, "doc_id bigint, lang string")
    return found.agg(F.lit(path.rsplit("/", 1)[-1]).alias("found"), F.count("doc_id").alias("records"))


@query(
    "context_docs",
    f"""SELECT CAST(item_id AS VARCHAR) AS id, {b.sql_strip("ltrim(" + b.sql_strip("split_part(text, chr(10), 1)") + ", '#')")} AS title, text
        FROM benchmark""",
)
def context_docs(spark, sf):
    return readers.context_documents(b.table(spark, sf, "benchmark"), "item_id", "text")


@query(
    "landed_pages_ingest",
    """SELECT user_id, event_id // 250 AS page, event_id % 250 AS pos, event_type FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS sighting FROM events)
       WHERE sighting = 1 ORDER BY page, pos LIMIT 100""",
)
def landed_pages_ingest(spark, sf):
    pages = b.table(spark, sf, "events").select(
        F.col("user_id"),
        F.expr("event_id div 250").alias("page"),
        (F.col("event_id") % 250).alias("pos"),
        "event_type",
    )
    return landed.landed_pages_ingest(pages, "user_id", ["page", "pos"], limit=100)


@query(
    "source_filter",
    f"""SELECT id, docketId, agencyId, postedDate FROM ({b.RAW}) r
        WHERE docketId = 'src7' AND agencyId = 'en' AND contains(lower(comment), 'the')
        AND substring(postedDate, 1, 10) BETWEEN '2024-02-01' AND '2024-10-31'""",
)
def source_filter(spark, sf):
    found = landed.source_filter(
        b.raw_records(spark, sf), "src7", "en", "The", "2024-02-01", "2024-10-31"
    )
    return found.select("id", "docketId", "agencyId", "postedDate")


def _details(spark, sf):
    """Headers of all documents, and details (with the text) of the labelled ones."""
    documents = b.table(spark, sf, "documents")
    headers = documents.select(
        "doc_id", F.lit(None).cast("string").alias("comment"), F.col("lang").alias("agencyId")
    )
    details = b.labelled(spark, sf).select("doc_id", "comment", F.col("label").alias("agencyId"))
    return headers, details


@query(
    "detail_or_header",
    f"""SELECT d.doc_id, l.comment, coalesce(l.label, d.lang) AS agencyId, l.doc_id IS NOT NULL AS has_detail
        FROM documents d LEFT JOIN ({b.LABELLED}) l ON l.doc_id = d.doc_id""",
)
def detail_or_header(spark, sf):
    return landed.detail_or_header(*_details(spark, sf), "doc_id")


@query(
    "text_body_count",
    "SELECT count(*) AS records, count(l.doc_id) AS with_text FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
)
def text_body_count(spark, sf):
    return landed.text_body_count(landed.detail_or_header(*_details(spark, sf), "doc_id"))


# ---------------------------------------------------------------------------------- cleaning

TAGGED_SQL = f"""
  cleaned AS (SELECT * EXCLUDE (comment), {b.sql_clean_html('comment')} AS comment FROM ({b.RAW}) r),
  tagged AS (SELECT *, CASE WHEN comment IS NULL OR comment = '' THEN 'null_or_empty'
      WHEN {b.sql_words('comment')} <= 15 AND regexp_matches(comment,
        '(?i)^(please\\s+)?(see|find)\\s+attach(ed|ment)\\b[^\\n]{{0,60}}$') THEN 'placeholder' END AS reason
    FROM cleaned),
  usable AS (SELECT *, row_number() OVER (PARTITION BY lower(comment) ORDER BY ord) AS copy
    FROM tagged WHERE reason IS NULL)"""


@query(
    "clean_raw",
    f"""WITH {TAGGED_SQL} SELECT id, comment, agencyId,
        CASE WHEN docketId = '' THEN commentOnDocumentId ELSE docketId END AS docketId, postedDate
        FROM usable WHERE copy = 1""",
)
def clean_raw(spark, sf):
    rows = curate.flatten_raw(b.nested(b.raw_records(spark, sf)))
    return curate.clean_raw(rows, "ord").drop("ord")


@query(
    "raw_clean_report",
    f"""WITH {TAGGED_SQL} SELECT (SELECT count(*) FROM tagged) AS total,
        (SELECT count(*) FROM tagged WHERE reason = 'null_or_empty') AS null_or_empty,
        (SELECT count(*) FROM tagged WHERE reason = 'placeholder') AS placeholder_only,
        (SELECT count(*) FROM usable WHERE copy > 1) AS exact_duplicate,
        (SELECT count(*) FROM usable WHERE copy = 1) AS kept""",
)
def raw_clean_report(spark, sf):
    return curate.raw_clean_report(b.raw_records(spark, sf))


@query(
    "dedup_normalized",
    f"""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (
          PARTITION BY {b.sql_strip('lower(text)')} ORDER BY doc_id) AS copy FROM documents) WHERE copy = 1""",
)
def dedup_normalized(spark, sf):
    return curate.dedup_normalized(b.table(spark, sf, "documents"), "text", "doc_id").select("doc_id")


@query(
    "dedup_exact",
    """SELECT doc_id, text FROM (SELECT doc_id, text, row_number() OVER (
         PARTITION BY text ORDER BY doc_id) AS copy FROM documents) WHERE copy = 1""",
)
def dedup_exact(spark, sf):
    return curate.dedup_exact(b.table(spark, sf, "documents").select("doc_id", "text"), "text", "doc_id")


@query(
    "dup_counts",
    """SELECT CAST(count(*) - count(DISTINCT text) AS BIGINT) AS exact_duplicate_comment_count,
       CAST(count(*) - count(DISTINCT (text, lang)) AS BIGINT) AS duplicate_comment_and_label_count FROM documents""",
)
def dup_counts(spark, sf):
    rows = b.table(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("comment"), F.col("lang").alias("label")
    )
    return quality.dup_counts(rows, "doc_id")


@query(
    "invalid_label_counts",
    f"""SELECT coalesce(trim(label), 'nan') AS label, count(*) AS "rows" FROM ({b.MESSY}) m
        WHERE coalesce(trim(label), 'nan') NOT IN ('Positive', 'Negative', 'Neutral') GROUP BY 1""",
)
def invalid_label_counts(spark, sf):
    return quality.invalid_label_counts(b.messy(spark, sf))


def cleaned_sql(action: str) -> str:
    keep = "" if action == "flag" else "WHERE valid"
    return f"""
  checked AS (SELECT * FROM (SELECT doc_id, comment, coalesce(trim(label), 'nan') AS label,
      coalesce(trim(label), 'nan') IN ('Positive', 'Negative', 'Neutral') AS valid FROM ({b.MESSY}) m) {keep}),
  filled AS (SELECT * FROM checked WHERE NOT {b.sql_empty('comment')}),
  firsts AS (SELECT *, row_number() OVER (PARTITION BY comment ORDER BY doc_id) AS copy FROM filled),
  normed AS (SELECT doc_id, label, valid, comment AS original_comment, {b.sql_norm('comment')} AS comment
    FROM firsts WHERE copy = 1),
  clean AS (SELECT *, length(comment) < 10 OR {b.sql_words('comment')} < 3 AS is_short_comment
    FROM normed WHERE NOT {b.sql_empty('comment')})"""


@query(
    "validate_and_clean",
    f"""WITH {cleaned_sql('remove')} SELECT doc_id, comment, label, original_comment, is_short_comment FROM clean""",
)
def validate_and_clean(spark, sf):
    return curate.validate_and_clean(b.messy(spark, sf), "doc_id")


@query(
    "validate_and_clean_flag",
    f"""WITH {cleaned_sql('flag')} SELECT doc_id, comment, label, original_comment, is_short_comment,
        NOT valid AS label_flagged_invalid FROM clean""",
)
def validate_and_clean_flag(spark, sf):
    return curate.validate_and_clean(b.messy(spark, sf), "doc_id", "flag")


DISTRIBUTION_SQL = """SELECT n.label, coalesce(c.n, 0) AS count, CAST(n.position AS INTEGER) AS position,
  round(100.0 * coalesce(c.n, 0) / t.total, 2)::DOUBLE AS percentage
  FROM (VALUES (0, 'Positive'), (1, 'Negative'), (2, 'Neutral')) n(position, label)
  LEFT JOIN (SELECT label, count(*) AS n FROM %s GROUP BY label) c ON c.label = n.label,
  (SELECT CAST(count(*) AS DOUBLE) AS total FROM %s) t"""


@query(
    "cleaned_label_distribution",
    f"WITH {cleaned_sql('remove')} {DISTRIBUTION_SQL % ('clean', 'clean')}",
)
def cleaned_label_distribution(spark, sf):
    """The flagship: sentiment shares after cleaning."""
    return quality.cleaned_label_distribution(b.messy(spark, sf), "doc_id")


@query(
    "label_distribution",
    f"WITH l AS ({b.LABELLED}) {DISTRIBUTION_SQL % ('l', 'l')}",
)
def label_distribution(spark, sf):
    return quality.label_distribution(b.labelled(spark, sf))


@query(
    "imbalance_ratio",
    f"""WITH c AS (SELECT count(*) AS n FROM ({b.LABELLED}) l GROUP BY label)
        SELECT round(max(n)::DOUBLE / min(n), 2) AS class_imbalance_ratio, max(n)::DOUBLE / min(n) >= 3.0 AS imbalanced FROM c""",
)
def imbalance_ratio(spark, sf):
    return quality.imbalance_ratio(b.labelled(spark, sf))


LENGTHS_SQL = """
  min(length(comment)) AS chars_min, max(length(comment)) AS chars_max, avg(length(comment)) AS chars_mean,
  quantile_cont(length(comment), 0.25) AS chars_p25, quantile_cont(length(comment), 0.5) AS chars_median,
  quantile_cont(length(comment), 0.75) AS chars_p75, quantile_cont(length(comment), 0.9) AS chars_p90,
  min({w}) AS words_min, max({w}) AS words_max, avg({w}) AS words_mean, quantile_cont({w}, 0.5) AS words_median
""".replace("{w}", b.sql_words("comment"))


def _rounded(report):
    return quality.tall(report).withColumn("value", F.round("value", 6))


def tall_sql(ctes: str, one_row: str) -> str:
    return f"""WITH {ctes}, one AS ({one_row}),
      doubles AS (SELECT CAST(COLUMNS(*) AS DOUBLE) FROM one)
      SELECT metric, round(value, 6) AS value FROM (UNPIVOT doubles ON COLUMNS(*) INTO NAME metric VALUE value)"""


@query(
    "length_profile",
    tall_sql(f"src AS (SELECT {b.sql_norm('text')} AS comment FROM documents)", f"SELECT {LENGTHS_SQL} FROM src"),
)
def length_profile(spark, sf):
    rows = b.table(spark, sf, "documents").select(text.normalize_text("text").alias("norm"))
    return _rounded(quality.length_profile(rows, "norm"))


@query(
    "length_sketch",
    f"""WITH sizes AS (SELECT length(comment) AS chars, {b.sql_words('comment')} AS words
          FROM (SELECT {b.sql_norm('text')} AS comment FROM documents)),
        measured AS (SELECT 'chars' AS measure, chars AS x FROM sizes UNION ALL SELECT 'words', words FROM sizes),
        shares AS (SELECT unnest([{', '.join(str(q) for q in quality.QUARTILES.values())}])::DOUBLE AS share)
      SELECT measure, share, CAST(count(*) AS BIGINT) AS rows, CAST(min(x) AS BIGINT) AS least, CAST(max(x) AS BIGINT) AS most,
        true AS within FROM measured, shares GROUP BY measure, share""",
)
def length_sketch(spark, sf):
    """Quartiles from merged sketches of each language; ``within`` holds their exact ranks against the stated error."""
    rows = b.table(spark, sf, "documents").select("lang", text.normalize_text("text").alias("norm"))
    sketches = quality.merge_length_sketches(quality.length_sketches(rows, "norm", ["lang"]))
    found = quality.length_estimates(sketches)
    sizes = rows.select(F.explode(F.array(
        F.struct(F.lit("chars").alias("measure"), F.length("norm").cast("bigint").alias("x")),
        F.struct(F.lit("words").alias("measure"), text.words_in("norm").cast("bigint").alias("x")),
    )).alias("s")).select("s.*")
    counted = sizes.join(F.broadcast(found), "measure").groupBy("measure", "share", "rows", "least", "most").agg(
        F.count_if(F.col("x") < F.col("estimate")).alias("below"), F.count_if(F.col("x") <= F.col("estimate")).alias("reached")
    )
    near = (F.col("below") / F.col("rows") <= F.col("share") + quality.RANK_ERROR) & (
        F.col("reached") / F.col("rows") >= F.col("share") - quality.RANK_ERROR
    )
    return counted.select("measure", "share", "rows", "least", "most", near.alias("within"))


COUNTS_SQL = ", ".join(f"count(*) FILTER (label = '{x}') AS count_{x}" for x in rules.LABELS)
SHARES_SQL = ", ".join(
    f"round(100.0 * count(*) FILTER (label = '{x}') / CAST(count(*) AS DOUBLE), 2) AS percentage_{x}"
    for x in rules.LABELS
)
QUALITY_SQL = f"""SELECT
  (SELECT count(*) FROM ({b.MESSY}) m) AS original_size,
  (SELECT count(*) FROM ({b.MESSY}) m WHERE coalesce(trim(label), 'nan') NOT IN ('Positive', 'Negative', 'Neutral')) AS invalid_label_count,
  (SELECT count(*) FROM checked WHERE {b.sql_empty('comment')}) AS empty_or_null_comments_removed,
  (SELECT count(*) FROM filled) AS size_before_duplicate_removal,
  (SELECT count(*) FROM firsts WHERE copy > 1) AS exact_duplicate_comment_count,
  (SELECT count(*) FROM firsts WHERE copy > 1) AS duplicates_removed,
  (SELECT count(*) - count(DISTINCT (comment, label)) FROM filled) AS duplicate_comment_and_label_count,
  (SELECT count(*) FROM normed WHERE {b.sql_empty('comment')}) AS empty_after_normalization_removed,
  count(*) FILTER (is_short_comment) AS short_comments_flagged, count(*) AS final_size,
  {COUNTS_SQL}, {SHARES_SQL}, {LENGTHS_SQL},
  (SELECT round(max(n)::DOUBLE / min(n), 2) FROM (SELECT count(*) AS n FROM clean
     WHERE label IN ('Positive', 'Negative', 'Neutral') GROUP BY label)) AS class_imbalance_ratio
  FROM clean"""
WARNINGS_SQL = """
  UNION ALL SELECT 'warning: ' || invalid_label_count || ' rows had labels outside [''Positive'', ''Negative'', ''Neutral''] and were {outcome}.', 1.0
    FROM one WHERE invalid_label_count > 0
  UNION ALL SELECT 'warning: ' || short_comments_flagged || ' comments are shorter than 3 words / 10 chars and were flagged (not removed).', 1.0
    FROM one WHERE short_comments_flagged > 0
  UNION ALL SELECT format('warning: Class imbalance: majority:minority ratio = {:.2f}.', class_imbalance_ratio), 1.0
    FROM one WHERE class_imbalance_ratio >= 3.0"""


@query(
    "quality_report",
    tall_sql(cleaned_sql("remove"), QUALITY_SQL) + WARNINGS_SQL.replace("{outcome}", "removed"),
)
def quality_report(spark, sf):
    return _rounded(quality.quality_report(b.messy(spark, sf), "doc_id"))


@query(
    "quality_report_flag",
    tall_sql(cleaned_sql("flag"), QUALITY_SQL) + WARNINGS_SQL.replace("{outcome}", "flagged"),
)
def quality_report_flag(spark, sf):
    return _rounded(quality.quality_report(b.messy(spark, sf), "doc_id", "flag"))


KIND_SQL = f"""CASE WHEN comment IS NULL OR comment = '' THEN 'null_or_empty'
  WHEN regexp_matches(lower(comment), '{"|".join(rules.ATTACHMENT_KEYWORDS)}') THEN 'attachment'
  ELSE 'substantive' END"""


@query(
    "kind_report",
    f"""SELECT kind, count(*) AS count, round(100.0 * count(*) / sum(count(*)) OVER (), 1)::DOUBLE AS percentage
        FROM (SELECT {KIND_SQL} AS kind FROM ({b.RAW}) r) GROUP BY kind""",
)
def kind_report(spark, sf):
    return quality.kind_report(b.raw_records(spark, sf))


@query(
    "first_samples",
    f"""SELECT ord, CASE WHEN length(t) > 200 THEN substring(t, 1, 200) || '...' ELSE t END AS sample
        FROM (SELECT ord, {b.sql_strip("replace(replace(replace(comment, '<br/>', chr(10)), '&rsquo;', ''''), '&mdash;', '—')")} AS t
              FROM ({b.RAW}) r WHERE {KIND_SQL} = 'substantive' ORDER BY ord LIMIT 5)""",
)
def first_samples(spark, sf):
    return quality.first_samples(b.raw_records(spark, sf), "ord")


@query(
    "pipeline_status",
    f"""WITH {cleaned_sql('remove')}
        SELECT 'raw' AS stage, (SELECT count(*) FROM documents) AS "rows", NULL::VARCHAR AS model, NULL::DOUBLE AS accuracy UNION ALL
        SELECT 'labeled', (SELECT count(*) FROM labels), NULL, NULL UNION ALL
        SELECT 'cleaned', (SELECT count(*) FROM clean), NULL, NULL UNION ALL SELECT 'scored', NULL, NULL, NULL UNION ALL
        SELECT 'model', NULL, 'always positive', round((SELECT avg((label = 'Positive')::INTEGER) FROM ({b.LABELLED}) l), 4)""",
)
def pipeline_status(spark, sf):
    """The model stage names its model and how well it does; here one that has a single answer."""
    answers = b.labelled(spark, sf).withColumn("predicted", F.lit("Positive"))
    report = {"model_type": "always positive", "accuracy": metrics.classification_metrics(answers).first()["accuracy"]}
    cleaned = curate.validate_and_clean(b.messy(spark, sf), "doc_id")
    stages = {"raw": b.table(spark, sf, "documents"), "labeled": b.table(spark, sf, "labels"), "cleaned": cleaned, "scored": None}
    return quality.pipeline_status(spark, stages, report)


@query(
    "stage_status",
    f"""WITH {cleaned_sql('remove')}
        SELECT 'raw' AS stage, (SELECT count(*) FROM documents) AS "rows" UNION ALL
        SELECT 'labeled', (SELECT count(*) FROM labels) UNION ALL
        SELECT 'cleaned', (SELECT count(*) FROM clean) UNION ALL SELECT 'model', NULL""",
)
def stage_status(spark, sf):
    cleaned = curate.validate_and_clean(b.messy(spark, sf), "doc_id")
    return quality.stage_status(
        spark,
        {"raw": b.table(spark, sf, "documents"), "labeled": b.table(spark, sf, "labels"), "cleaned": cleaned, "model": None},
    )


# ------------------------------------------------------------------------------------- joins


def _done(spark, sf):
    """The labelled documents as processed earlier, half of them under a changed text."""
    changed = F.when(F.col("doc_id") % 2 == 0, F.col("comment")).otherwise(F.concat("comment", F.lit("!")))
    rows = b.labelled(spark, sf).withColumn("comment", changed)
    return hashed(rows, "doc_id", "comment")


DONE_SQL = f"SELECT doc_id, sha256(CASE WHEN doc_id % 2 = 0 THEN comment ELSE comment || '!' END) AS text_sha FROM ({b.LABELLED}) l"


@query(
    "resume_anti_join",
    f"""SELECT doc_id, sha256(text) AS text_sha FROM documents d WHERE NOT EXISTS (
          SELECT 1 FROM ({DONE_SQL}) p WHERE p.doc_id = d.doc_id AND p.text_sha = sha256(d.text))""",
)
def resume_anti_join_query(spark, sf):
    rows = hashed(b.table(spark, sf, "documents"), "doc_id", "text")
    return resume_anti_join(rows, _done(spark, sf), "doc_id").select("doc_id", "text_sha")


@query(
    "resume_mismatch",
    f"""SELECT d.doc_id, sha256(d.text) AS text_sha, p.text_sha AS earlier_sha
        FROM documents d JOIN ({DONE_SQL}) p ON p.doc_id = d.doc_id WHERE p.text_sha <> sha256(d.text)""",
)
def resume_mismatch_query(spark, sf):
    rows = hashed(b.table(spark, sf, "documents"), "doc_id", "text")
    found = resume_mismatch(rows, _done(spark, sf), "doc_id")
    return found.select("doc_id", "text_sha", "earlier_sha")


@query(
    "class_weight_join",
    f"""WITH c AS (SELECT label, count(*) AS n FROM ({b.LABELLED}) l GROUP BY label)
        SELECT l.doc_id, l.label, round(t.total / (t.k * CAST(c.n AS DOUBLE)), 6) AS class_weight
        FROM ({b.LABELLED}) l JOIN c ON c.label = l.label, (SELECT sum(n)::DOUBLE AS total, count(*) AS k FROM c) t""",
)
def class_weight_join(spark, sf):
    rows = b.labelled(spark, sf).select("doc_id", "label")
    weights = features.class_weights(sampling.class_sizes(rows))
    joined = features.class_weight_join(rows, weights)
    return joined.withColumn("class_weight", F.round("class_weight", 6))


# ------------------------------------------------------------------- summaries, trends, words


@query(
    "sentiment_summary",
    f"""WITH c AS (SELECT count(*) AS total_comments,
          count(*) FILTER (predicted = 'Positive') AS count_Positive,
          count(*) FILTER (predicted = 'Negative') AS count_Negative,
          count(*) FILTER (predicted = 'Neutral') AS count_Neutral FROM ({b.PREDICTED}) p),
        s AS (SELECT *, round(100.0 * count_Positive / CAST(total_comments AS DOUBLE), 2) AS percentage_Positive,
          round(100.0 * count_Negative / CAST(total_comments AS DOUBLE), 2) AS percentage_Negative,
          round(100.0 * count_Neutral / CAST(total_comments AS DOUBLE), 2) AS percentage_Neutral,
          CASE greatest(count_Positive, count_Negative, count_Neutral) WHEN count_Positive THEN 'Positive'
            WHEN count_Negative THEN 'Negative' ELSE 'Neutral' END AS most_common_sentiment FROM c)
        SELECT *, 'Of the ' || total_comments || ' analyzed comments, ' || most_common_sentiment
          || ' is the most frequently observed sentiment ('
          || greatest(percentage_Positive, percentage_Negative, percentage_Neutral) || '%).' || chr(10)
          || 'Negative sentiment was observed in ' || percentage_Negative || '% of analyzed comments.' || chr(10)
          || 'Positive sentiment was observed in ' || percentage_Positive || '% of analyzed comments.' || chr(10)
          || '{rules.INSIGHT_CAVEAT}' AS insights FROM s""",
)
def sentiment_summary(spark, sf):
    summary = insights.sentiment_summary(b.predicted(spark, sf), "predicted")
    return summary.withColumn("insights", F.array_join("insights", "\n"))


@query(
    "monthly_trend",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       count(*) FILTER (o_orderstatus = 'O') AS Positive, count(*) FILTER (o_orderstatus = 'F') AS Negative,
       count(*) FILTER (o_orderstatus = 'P') AS Neutral FROM orders GROUP BY 1""",
)
def monthly_trend(spark, sf):
    status = F.when(F.col("o_orderstatus") == "O", "Positive").when(
        F.col("o_orderstatus") == "F", "Negative"
    ).when(F.col("o_orderstatus") == "P", "Neutral")
    dated = b.table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("string").alias("posted_date"), status.alias("sentiment")
    )
    return insights.monthly_trend(dated, "posted_date", "sentiment")


STOP = b.sql_in(rules.ALL_STOP_WORDS)
DOC_WORDS_SQL = f"""
  docs AS (SELECT doc_id, label, comment FROM ({b.LABELLED}) l),
  words AS (SELECT label, word FROM (SELECT label, unnest(list_distinct(
      regexp_extract_all(lower(comment), '[a-zA-Z'']+'))) AS word FROM docs)
    WHERE length(word) > 2 AND word NOT IN ({STOP})),
  counted AS (SELECT label, word, count(*) AS docs_in FROM words GROUP BY ALL),
  sizes AS (SELECT label, count(*) AS n_in, sum(count(*)) OVER () AS n_all FROM docs GROUP BY label),
  scored AS (SELECT c.label, c.word, c.docs_in, (c.docs_in::DOUBLE / n_in)
      / ((sum(c.docs_in) OVER (PARTITION BY c.word) - c.docs_in + 1)::DOUBLE / (n_all - n_in + 1)) AS score
    FROM counted c JOIN sizes s ON s.label = c.label)"""


@query(
    "doc_frequency",
    f"""SELECT word, count(*) AS docs FROM (SELECT unnest(list_distinct(
          regexp_extract_all(lower(text), '[a-zA-Z'']+'))) AS word FROM documents)
        WHERE length(word) > 2 AND word NOT IN ({STOP}) GROUP BY word""",
)
def doc_frequency(spark, sf):
    return insights.doc_frequency(b.table(spark, sf, "documents"), "text")


@query(
    "distinctive_words",
    f"WITH {DOC_WORDS_SQL} SELECT label, word, docs_in, round(score, 6) AS score FROM scored WHERE docs_in >= 3",
)
def distinctive_words(spark, sf):
    return insights.distinctive_words(b.labelled(spark, sf)).withColumn("score", F.round("score", 6))


@query(
    "topk_words",
    f"""WITH {DOC_WORDS_SQL}, ranked AS (SELECT *, row_number() OVER (
          PARTITION BY label ORDER BY score DESC, word) AS rank FROM scored WHERE docs_in >= 3)
        SELECT label, word, docs_in, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 40""",
)
def topk_words(spark, sf):
    return insights.topk_words(b.labelled(spark, sf)).withColumn("score", F.round("score", 6))


# -------------------------------------------------------------------------------- evaluation


@query(
    "confusion_matrix",
    f"""SELECT a.x AS true_label, p.x AS predicted_label, count(r.doc_id) AS n
        FROM (VALUES ('Positive'), ('Negative'), ('Neutral')) a(x)
        JOIN (VALUES ('Positive'), ('Negative'), ('Neutral')) p(x) ON true
        LEFT JOIN ({b.PREDICTED}) r ON r.label = a.x AND r.predicted = p.x GROUP BY ALL""",
)
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(b.predicted(spark, sf))


METRICS_FROM_P = """
  c AS (SELECT x AS label, (SELECT count(*) FROM p WHERE label = x AND predicted = x)::DOUBLE AS hit,
      (SELECT count(*) FROM p WHERE label = x)::DOUBLE AS support,
      (SELECT count(*) FROM p WHERE predicted = x)::DOUBLE AS named
    FROM (VALUES ('Positive'), ('Negative'), ('Neutral')) v(x)),
  m AS (SELECT label, support, CASE WHEN named > 0 THEN hit / named ELSE 0 END AS precision,
      CASE WHEN support > 0 THEN hit / support ELSE 0 END AS recall,
      CASE WHEN named + support > 0 THEN 2 * hit / (named + support) ELSE 0 END AS f1 FROM c)"""
METRICS_SQL = f"p AS ({b.PREDICTED}), {METRICS_FROM_P}"


@query(
    "classification_metrics",
    f"""WITH {METRICS_SQL} SELECT
        round((SELECT count(*) FILTER (label = predicted)::DOUBLE / count(*) FROM p), 4) AS accuracy,
        round(avg(precision), 4) AS precision_macro, round(avg(recall), 4) AS recall_macro, round(avg(f1), 4) AS f1_macro,
        round(sum(precision * support) / sum(support), 4) AS precision_weighted,
        round(sum(recall * support) / sum(support), 4) AS recall_weighted,
        round(sum(f1 * support) / sum(support), 4) AS f1_weighted FROM m""",
)
def classification_metrics(spark, sf):
    return metrics.classification_metrics(b.predicted(spark, sf)).select(*metrics.SCORES)


@query(
    "per_class_metrics",
    f"""WITH {METRICS_SQL} SELECT label, round(precision, 4) AS precision, round(recall, 4) AS recall,
        round(f1, 4) AS f1, CAST(support AS BIGINT) AS support FROM m""",
)
def per_class_metrics(spark, sf):
    return metrics.class_table(metrics.classification_metrics(b.predicted(spark, sf)))


@query(
    "classification_report",
    f"""WITH {METRICS_SQL}, body AS (
          SELECT CASE label WHEN 'Positive' THEN 1 WHEN 'Negative' THEN 2 ELSE 3 END AS line,
            printf('%12s %9.2f %9.2f %9.2f %9d', label, precision::DOUBLE, recall::DOUBLE, f1::DOUBLE, support::BIGINT) AS text FROM m
          UNION ALL SELECT 0, printf('%12s %9s %9s %9s %9s', '', 'precision', 'recall', 'f1-score', 'support')
          UNION ALL SELECT 4, printf('%12s %9s %9s %9.2f %9d', 'accuracy', '', '', (count(*) FILTER (label = predicted))::DOUBLE / count(*), count(*)) FROM p
          UNION ALL SELECT 5, printf('%12s %9.2f %9.2f %9.2f %9d', 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT) FROM m
          UNION ALL SELECT 6, printf('%12s %9.2f %9.2f %9.2f %9d', 'weighted avg', sum(precision * support) / sum(support),
            sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)::BIGINT) FROM m)
        SELECT CAST(line AS INTEGER) AS line, text FROM body""",
)
def classification_report(spark, sf):
    return metrics.classification_report(b.predicted(spark, sf))


def _by_language(spark, sf):
    """The rule's scores per language: a table of candidates to rank."""
    rows = None
    for i, lang in enumerate(["de", "en", "es", "fr"]):
        one = metrics.classification_metrics(b.predicted(spark, sf).filter(F.col("lang") == lang))
        one = one.select(F.lit(lang).alias("model"), "accuracy", "f1_macro", "f1_weighted", F.lit(i).alias("candidate"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


BY_LANGUAGE_SQL = f"""
  p AS ({b.PREDICTED}),
  c AS (SELECT lang, x AS label, count(*) FILTER (label = x AND predicted = x)::DOUBLE AS hit,
      count(*) FILTER (label = x)::DOUBLE AS support, count(*) FILTER (predicted = x)::DOUBLE AS named
    FROM p, (VALUES ('Positive'), ('Negative'), ('Neutral')) v(x) GROUP BY ALL),
  m AS (SELECT lang, support, CASE WHEN named + support > 0 THEN 2 * hit / (named + support) ELSE 0 END AS f1 FROM c),
  a AS (SELECT lang, count(*) FILTER (label = predicted)::DOUBLE / count(*) AS accuracy FROM p GROUP BY lang),
  models AS (SELECT lang AS model, round(any_value(accuracy), 4) AS accuracy, round(avg(f1), 4) AS f1_macro,
      round(sum(f1 * support) / sum(support), 4) AS f1_weighted,
      CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS candidate FROM m JOIN a USING (lang) GROUP BY lang)"""


@query(
    "rank_models",
    f"""WITH {BY_LANGUAGE_SQL} SELECT model, accuracy, f1_macro, f1_weighted, candidate FROM models
        ORDER BY f1_macro DESC, f1_weighted DESC, accuracy DESC, candidate LIMIT 1""",
)
def rank_models(spark, sf):
    return metrics.rank_models(_by_language(spark, sf)).limit(1)


@query(
    "comparison_table",
    f"WITH {BY_LANGUAGE_SQL} SELECT model, accuracy, f1_macro AS macro_f1, f1_weighted AS weighted_f1 FROM models",
)
def comparison_table(spark, sf):
    return metrics.comparison_table(_by_language(spark, sf))


@query(
    "unpivot_metrics",
    f"""WITH {BY_LANGUAGE_SQL}, t AS (SELECT model, accuracy, f1_macro AS macro_f1, f1_weighted AS weighted_f1 FROM models)
        UNPIVOT t ON accuracy, macro_f1, weighted_f1 INTO NAME metric VALUE score""",
)
def unpivot_metrics(spark, sf):
    return metrics.unpivot_metrics(metrics.comparison_table(_by_language(spark, sf)))


# ----------------------------------------------------------------- windows, samples and splits


@query(
    "history_trim",
    """SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (
         PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations) WHERE back <= 6""",
)
def history_trim(spark, sf):
    return dialog.history_trim(b.table(spark, sf, "conversations"))


@query(
    "chat_contents",
    """SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS position,
       CASE role WHEN 'assistant' THEN 'model' ELSE role END AS role, text
       FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations)
       WHERE back <= 6""",
)
def chat_contents(spark, sf):
    contents = dialog.chat_contents(b.table(spark, sf, "conversations"))
    messages = contents.select("conv_id", F.posexplode("contents").alias("position", "m"))
    return messages.select("conv_id", "position", "m.role", F.col("m.parts")[0]["text"].alias("text"))


@query(
    "review_sample",
    f"""SELECT doc_id, comment, label, '' AS human_reviewed_label FROM ({b.LABELLED}) l
        ORDER BY md5('42:' || doc_id), doc_id LIMIT 50""",
)
def review_sample(spark, sf):
    return sampling.review_sample(b.labelled(spark, sf), "doc_id")


@query(
    "random_comment",
    "SELECT doc_id, text FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 1",
)
def random_comment(spark, sf):
    return sampling.random_comment(b.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


@query("row_limit", "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 100")
def row_limit(spark, sf):
    return sampling.row_limit(b.table(spark, sf, "documents").select("doc_id", "source"), "doc_id", 100)


def quota_sql(name: str, sizes: str, draws: str) -> str:
    """Largest-remainder shares of ``draws`` rows over the classes of ``sizes`` (label, n)."""
    return f"""
  {name}_x AS (SELECT label, n, n / sum(n) OVER () * ({draws}) AS exact, {draws} AS draws FROM {sizes}),
  {name}_f AS (SELECT *, row_number() OVER (ORDER BY exact - floor(exact) DESC,
      list_position(['Positive', 'Negative', 'Neutral'], label)) AS place,
      draws - sum(floor(exact)) OVER () AS missing FROM {name}_x),
  {name} AS (SELECT label, n, floor(exact) + CASE WHEN place <= missing THEN 1 ELSE 0 END AS quota FROM {name}_f)"""


# Both branches of the split in one: without a validation part its quotas are zero.
SPLIT_SQL = f"""
  src AS ({b.LABELLED}),
  sizes AS (SELECT label, count(*)::DOUBLE AS n FROM src GROUP BY label),
  plan AS (SELECT sum(n) AS n, sum(n) >= 150 AND min(n) >= 10 AS three FROM sizes),
  parts AS (SELECT n, three, CASE WHEN three THEN ceil((0.15::DOUBLE + 0.15::DOUBLE) * n) ELSE ceil(0.2::DOUBLE * n) END AS held FROM plan),
  goal AS (SELECT *, n - held AS train, CASE WHEN three THEN ceil(0.5 * held) ELSE held END AS test FROM parts),
  {quota_sql('tq', 'sizes', '(SELECT train FROM goal)')},
  rest AS (SELECT label, n - quota AS n FROM tq),
  {quota_sql('vq', 'rest', '(SELECT held - test FROM goal)')},
  ranked AS (SELECT src.*, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id), doc_id) AS place FROM src),
  split AS (SELECT r.doc_id, r.label, r.comment, CASE WHEN place <= tq.quota THEN 'train'
      WHEN place <= tq.quota + vq.quota THEN 'val' ELSE 'test' END AS split
    FROM ranked r JOIN tq ON tq.label = r.label JOIN vq ON vq.label = r.label)"""


@query("stratified_split", f"WITH {SPLIT_SQL} SELECT doc_id, label, split FROM split")
def stratified_split(spark, sf):
    split, _ = sampling.stratified_split(b.labelled(spark, sf).select("doc_id", "label"), "doc_id")
    return split


@query(
    "split_info",
    f"""WITH {SPLIT_SQL} SELECT CASE WHEN three THEN 'stratified_70_15_15' ELSE 'fallback_80_20' END AS strategy,
        train::BIGINT AS train_size, (held - test)::BIGINT AS val_size, test::BIGINT AS test_size,
        CAST(42 AS BIGINT) AS random_state FROM goal""",
)
def split_info(spark, sf):
    _, info = sampling.stratified_split(b.labelled(spark, sf).select("doc_id", "label"), "doc_id")
    return spark.createDataFrame([info], "strategy string, train_size bigint, val_size bigint, test_size bigint, random_state bigint")


@query("write_splits", f"WITH {SPLIT_SQL} SELECT doc_id, comment, label, split FROM split")
def write_splits(spark, sf):
    split, _ = sampling.stratified_split(b.labelled(spark, sf), "doc_id")
    path = work_folder(spark, "splits")
    writers.write_splits(split, path)
    return spark.read.parquet(path).select("doc_id", "comment", "label", F.col("split").cast("string"))


@query(
    "union_splits",
    f"WITH {SPLIT_SQL} SELECT label, count(*) AS \"rows\" FROM split WHERE split IN ('train', 'val') GROUP BY label",
)
def union_splits(spark, sf):
    split, _ = sampling.stratified_split(b.labelled(spark, sf), "doc_id")
    both = sampling.union_splits(split, "train", "val")
    return both.groupBy("label").agg(F.count("*").alias("rows"))


@query(
    "stratified_folds",
    f"""WITH src AS ({b.LABELLED})
        SELECT doc_id, label, CAST(ntile(3) OVER (PARTITION BY label ORDER BY md5('42:' || doc_id), doc_id) - 1 AS INTEGER) AS fold FROM src""",
)
def stratified_folds(spark, sf):
    return sampling.stratified_folds(b.labelled(spark, sf).select("doc_id", "label"), "doc_id")
