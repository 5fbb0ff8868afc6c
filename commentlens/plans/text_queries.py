"""Scalar rules and predicates over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentlens import rules
from commentlens.functions import dates, labels, text, tokens
from commentlens.operators import curate, lookup, metrics
from commentlens.operators.dialog import build_prompt
from commentlens.operators.features import known_vocabulary, tfidf_vocab, vectorizer
from commentlens.plans import bindings as b
from commentlens.plans.registry import query


@query(
    "clean_html_text",
    f"SELECT page_id, {b.sql_clean_html('html')} AS text FROM pages",
)
def clean_html_text(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", text.clean_html_text("html").alias("text"))


@query("normalize_text", f"SELECT page_id, {b.sql_norm('html')} AS text FROM pages")
def normalize_text(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", text.normalize_text("html").alias("text"))


@query(
    "word_count",
    f"SELECT doc_id, CAST({b.sql_words('text')} AS BIGINT) AS words FROM documents",
)
def word_count(spark, sf):
    words = text.word_count("text").cast("bigint")
    return b.table(spark, sf, "documents").select("doc_id", words.alias("words"))


@query("char_len", "SELECT doc_id, CAST(length(text) AS BIGINT) AS chars FROM documents")
def char_len(spark, sf):
    chars = F.length("text").cast("bigint")
    return b.table(spark, sf, "documents").select("doc_id", chars.alias("chars"))


@query("comment_hash", "SELECT doc_id, sha256(text) AS text_sha FROM documents")
def comment_hash(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id", text.comment_hash("text").alias("text_sha"))


@query(
    "null_or_empty",
    f"SELECT doc_id, {b.sql_empty('comment')} AS empty FROM ({b.MESSY}) m",
)
def null_or_empty(spark, sf):
    return b.messy(spark, sf).select("doc_id", text.null_or_empty("comment").alias("empty"))


@query(
    "is_blank",
    f"SELECT doc_id, (comment IS NULL OR {b.sql_strip('comment')} = '') AS blank FROM ({b.MESSY}) m",
)
def is_blank(spark, sf):
    return b.messy(spark, sf).select("doc_id", text.is_blank("comment").alias("blank"))


PLACEHOLDER_SQL = r"(?i)^(please\s+)?(see|find)\s+attach(ed|ment)\b[^\n]{0,60}$"


@query(
    "placeholder_only",
    f"""SELECT id, comment IS NOT NULL AND {b.sql_words('comment')} <= 15
        AND regexp_matches({b.sql_strip('comment')}, '{PLACEHOLDER_SQL}') AS placeholder
        FROM ({b.RAW}) r""",
)
def placeholder_only(spark, sf):
    found = F.coalesce(text.placeholder_only("comment"), F.lit(False))
    return b.raw_records(spark, sf).select("id", found.alias("placeholder"))


@query(
    "label_valid",
    f"""SELECT doc_id, coalesce(trim(label), 'nan') AS label,
        coalesce(trim(label), 'nan') IN ('Positive', 'Negative', 'Neutral') AS valid
        FROM ({b.MESSY}) m""",
)
def label_valid(spark, sf):
    return b.messy(spark, sf).select(
        "doc_id", labels.label_key("label").alias("label"), labels.label_valid("label").alias("valid")
    )


@query(
    "drop_unusable",
    f"""SELECT doc_id, comment, label FROM ({b.MESSY}) m
        WHERE comment IS NOT NULL AND label IN ('Positive', 'Negative', 'Neutral')""",
)
def drop_unusable(spark, sf):
    return curate.drop_unusable(b.messy(spark, sf))


@query(
    "short_flag",
    f"""SELECT doc_id, length(n) < 10 OR {b.sql_words('n')} < 3 AS is_short
        FROM (SELECT doc_id, {b.sql_norm("coalesce(comment, '')")} AS n FROM ({b.MESSY}) m)""",
)
def short_flag(spark, sf):
    norm = text.normalize_text("comment")
    rows = b.messy(spark, sf).select("doc_id", norm.alias("norm"))
    return rows.select("doc_id", text.short_flag("norm").alias("is_short"))


KIND_SQL = f"""CASE WHEN comment IS NULL OR comment = '' THEN 'null_or_empty'
  WHEN regexp_matches(lower(comment), '{"|".join(rules.ATTACHMENT_KEYWORDS)}') THEN 'attachment'
  ELSE 'substantive' END"""


@query("comment_kind", f"SELECT id, {KIND_SQL} AS kind FROM ({b.RAW}) r")
def comment_kind(spark, sf):
    return b.raw_records(spark, sf).select("id", text.comment_kind("comment").alias("kind"))


@query(
    "docket_fallback",
    f"SELECT id, CASE WHEN docketId = '' THEN commentOnDocumentId ELSE docketId END AS docket FROM ({b.RAW}) r",
)
def docket_fallback(spark, sf):
    docket = curate.docket_fallback("docketId", "commentOnDocumentId")
    return b.raw_records(spark, sf).select("id", docket.alias("docket"))


@query(
    "soften_entities",
    """SELECT page_id, replace(replace(replace(html, '<br/>', chr(10)), '&rsquo;', ''''), '&mdash;', '—') AS text
       FROM pages""",
)
def soften_entities(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", text.soften_entities("html").alias("text"))


# Labeler answers made of the table: a bare label, a sentence, reasoning, quotes, two labels, none.
ANSWERS = """
SELECT doc_id, CASE doc_id % 8
  WHEN 0 THEN 'Positive' WHEN 1 THEN concat('<think>', text, ' Negative</think>\n neutral')
  WHEN 2 THEN concat('It is negative: ', text) WHEN 3 THEN '```"Neutral"```'
  WHEN 4 THEN 'Positive or Negative' WHEN 5 THEN concat('''', 'POSITIVE', '''')
  WHEN 6 THEN '' ELSE text END AS answer
FROM documents"""


@query(
    "parse_label",
    f"""WITH a AS (SELECT doc_id, regexp_extract_all(
          regexp_replace(answer, '(?is)<think>.*?</think>', '', 'g'),
          '(?i)\\b(Positive|Negative|Neutral)\\b') AS found
        FROM ({ANSWERS.replace(chr(92) + 'n', ' ')}) x)
        SELECT doc_id, CASE WHEN len(found) = 1
          THEN upper(found[1][1]) || lower(substring(found[1], 2)) END AS label FROM a""",
)
def parse_label(spark, sf):
    answers = spark.sql(
        ANSWERS.replace("documents", "{documents}"), documents=b.table(spark, sf, "documents")
    )
    return answers.select("doc_id", labels.parse_label("answer").alias("label"))


@query(
    "shift_api_date",
    f"""SELECT id, strftime(strptime(split_part(rtrim(postedDate, 'Z'), '.', 1), '%Y-%m-%dT%H:%M:%S')
        - INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS moved FROM ({b.RAW}) r""",
)
def shift_api_date(spark, sf):
    return b.raw_records(spark, sf).select("id", dates.shift_api_date("postedDate").alias("moved"))


@query(
    "find_date_column",
    f"""SELECT CASE WHEN count(try_cast(postedDate AS TIMESTAMP)) > 0 THEN 'Posted_Date' END AS date_column
        FROM ({b.RAW}) r""",
)
def find_date_column(spark, sf):
    rows = b.raw_records(spark, sf).select(
        F.col("agencyId").alias("date"), F.col("postedDate").alias("Posted_Date"), "id"
    )
    found = dates.find_date_column(rows)
    return rows.limit(1).select(F.lit(found).alias("date_column"))


STOP = b.sql_in(rules.ALL_STOP_WORDS)
WORDS_SQL = f"""list_filter(list_distinct(regexp_extract_all(lower(%s), '[a-zA-Z'']+')),
  lambda w: length(w) > 2 AND w NOT IN ({STOP}))"""


@query(
    "tokenize_words",
    f"SELECT doc_id, unnest({WORDS_SQL % 'text'}) AS word FROM documents",
)
def tokenize_words(spark, sf):
    words = F.explode(tokens.tokenize_words("text"))
    return b.table(spark, sf, "documents").select("doc_id", words.alias("word"))


@query(
    "stopword_difference",
    f"""SELECT doc_id, CAST(len(list_distinct(regexp_extract_all(lower(text), '[a-zA-Z'']+'))) AS BIGINT) AS all_words,
        CAST(len({WORDS_SQL % 'text'}) AS BIGINT) AS kept_words FROM documents""",
)
def stopword_difference(spark, sf):
    all_words = F.array_distinct(
        F.regexp_extract_all(F.lower("text"), F.lit("[a-zA-Z']+"), F.lit(0))
    )
    return b.table(spark, sf, "documents").select(
        "doc_id",
        F.size(all_words).cast("bigint").alias("all_words"),
        F.size(tokens.tokenize_words("text")).cast("bigint").alias("kept_words"),
    )


@query(
    "keyword_words",
    "SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-zA-Z]{3,}'))) AS word FROM documents",
)
def keyword_words(spark, sf):
    words = F.explode(tokens.keyword_words("text"))
    return b.table(spark, sf, "documents").select("doc_id", words.alias("word"))


def terms_sql(source: str, prefix: str = "") -> str:
    """Terms of a table's comments with their frequency: unigrams and neighbouring pairs."""
    return rf"""
  {prefix}toks AS (SELECT doc_id, label, regexp_extract_all(lower(comment), '[\p{{L}}\p{{N}}_]{{2,}}') AS w FROM {source}),
  {prefix}grams AS (
    SELECT doc_id, label, unnest(w) AS term FROM {prefix}toks
    UNION ALL
    SELECT doc_id, label, w[i] || ' ' || w[i + 1] FROM (
      SELECT doc_id, label, w, unnest(generate_series(1, len(w) - 1)) AS i FROM {prefix}toks WHERE len(w) > 1)),
  {prefix}tf AS (SELECT doc_id, label, term, count(*) AS tf FROM {prefix}grams GROUP BY ALL)"""


TERMS_SQL = terms_sql("src")
# Texts without any word of a vocabulary, planted by id.
UNKNOWN_TEXT = "CASE WHEN doc_id % 7 = 3 THEN concat('qzx', doc_id, 'vkj wqq', doc_id, 'zzk') ELSE text END"


@query(
    "tokenize_tfidf",
    f"""WITH src AS (SELECT doc_id, '' AS label, text AS comment FROM documents), {TERMS_SQL}
        SELECT doc_id, term, CAST(tf AS BIGINT) AS tf FROM tf""",
)
def tokenize_tfidf(spark, sf):
    counts = tokens.term_counts(tokens.tokenize_tfidf("text"))
    rows = b.table(spark, sf, "documents").select("doc_id", F.inline(counts))
    return rows.withColumn("tf", F.col("tf").cast("bigint"))


@query(
    "display_model_name",
    f"""SELECT doc_id, CASE source WHEN 'src0' THEN 'TF-IDF + Logistic Regression (tuned)'
        WHEN 'src1' THEN 'TF-IDF + Linear SVM' ELSE source END AS model FROM documents""",
)
def display_model_name(spark, sf):
    key = (
        F.when(F.col("source") == "src0", "tfidf_logreg_tuned")
        .when(F.col("source") == "src1", "tfidf_linear_svm")
        .otherwise(F.col("source"))
    )
    rows = b.table(spark, sf, "documents").select("doc_id", key.alias("key"))
    return rows.select("doc_id", metrics.display_model_name("key").alias("model"))


@query(
    "build_prompt",
    """SELECT conv_id, turn, 'REGULATORY CONTEXT:' || chr(10) || b.text || chr(10) || chr(10) || 'USER QUESTION:'
        || chr(10) || c.text || chr(10) || chr(10) || 'Answer using ONLY the context above where possible; '
        || 'if it''s insufficient, say so explicitly.' AS prompt
       FROM conversations c JOIN benchmark b ON b.item_id = c.conv_id % (SELECT count(*) FROM benchmark) WHERE role = 'user'""",
)
def prompts(spark, sf):
    asked = b.table(spark, sf, "conversations").filter("role = 'user'")
    context = b.table(spark, sf, "benchmark").select(
        (F.col("item_id")).alias("item"), F.col("text").alias("context")
    )
    rows = asked.withColumn("item", F.col("conv_id") % context.count()).join(context, "item")
    return rows.select("conv_id", "turn", build_prompt(F.col("context"), F.col("text")).alias("prompt"))


@query(
    "round_stats",
    """SELECT source, round(avg(n_chars), 2) AS mean_2, round(100.0 * count(*) FILTER (lang = 'en') / count(*), 1) AS en_1,
       round(CAST(count(*) FILTER (lang = 'fr') AS DOUBLE) / count(*), 4) AS fr_4
       FROM documents GROUP BY source""",
)
def round_stats(spark, sf):
    return b.table(spark, sf, "documents").groupBy("source").agg(
        F.round(F.avg("n_chars"), 2).alias("mean_2"),
        F.round(F.lit(100.0) * F.count_if(F.col("lang") == "en") / F.count("*"), 1).alias("en_1"),
        F.round(F.count_if(F.col("lang") == "fr") / F.count("*"), 4).alias("fr_4"),
    )


@query(
    "word_intersection",
    """SELECT d.doc_id, CAST(len(list_intersect(
         list_distinct(regexp_extract_all(lower(d.text), '[a-zA-Z]{3,}')),
         list_distinct(regexp_extract_all(lower(b.text), '[a-zA-Z]{3,}')))) AS BIGINT) AS shared
       FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % (SELECT count(*) FROM benchmark)""",
)
def word_intersection(spark, sf):
    items = b.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("item"), tokens.keyword_words("text").alias("other")
    )
    rows = b.table(spark, sf, "documents").withColumn("item", F.col("doc_id") % items.count()).join(items, "item")
    shared = lookup.word_intersection(tokens.keyword_words("text"), F.col("other"))
    return rows.select("doc_id", shared.cast("bigint").alias("shared"))


@query(
    "keyword_overlap_match",
    """WITH q AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-zA-Z]{3,}'))) AS w FROM documents),
       d AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-zA-Z]{3,}'))) AS w FROM benchmark),
       s AS (SELECT doc_id, item_id, count(*) AS score FROM q JOIN d USING (w) GROUP BY ALL),
       r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, item_id) AS k FROM s)
       SELECT t.doc_id AS question, r.item_id AS document, CAST(coalesce(r.score, 0) AS BIGINT) AS score
       FROM documents t LEFT JOIN r ON r.doc_id = t.doc_id AND r.k = 1""",
)
def keyword_overlap_match(spark, sf):
    return lookup.keyword_overlap_match(
        b.table(spark, sf, "documents"), "doc_id", "text",
        b.table(spark, sf, "benchmark"), "item_id", "text",
    )


@query(
    "known_vocabulary",
    rf"""WITH src AS (SELECT doc_id, label, comment FROM ({b.LABELLED}) l), {TERMS_SQL},
       vocab AS (SELECT term, sum(tf) AS cf FROM tf GROUP BY term
                 HAVING count(*) >= 2 AND count(*) <= 0.95 * (SELECT count(*) FROM src)
                 ORDER BY cf DESC, term LIMIT 20000),
       words AS (SELECT doc_id, unnest(regexp_extract_all(lower({UNKNOWN_TEXT}), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM documents)
       SELECT doc_id, doc_id IN (SELECT w.doc_id FROM words w JOIN vocab USING (term)) AS known FROM documents""",
)
def known_vocabulary_query(spark, sf):
    """The whole vocabulary; every seventh text is written in words that none of it holds."""
    vocab = tfidf_vocab(b.labelled(spark, sf)).collect()
    model = vectorizer([(r["term"], r["idf"]) for r in vocab])
    rows = b.table(spark, sf, "documents").select("doc_id", F.expr(UNKNOWN_TEXT).alias("comment"))
    return model.transform(rows).select("doc_id", known_vocabulary(F.col("features")).alias("known"))
