"""Features, classifiers, scoring and labelling over whole tables.

Features have SQL equivalents. What a trained model answers is checked by its rows and, in the
tests, by its properties.
"""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from commentlens import rules
from commentlens.functions.labels import label_rank
from commentlens.operators import features, labeling, metrics, models, sampling, scoring
from commentlens.plans import bindings as b
from commentlens.plans.registry import query
from commentlens.plans.table_queries import METRICS_FROM_P, SPLIT_SQL
from commentlens.plans.text_queries import terms_sql
from commentlens.session import work_folder, written

# Vocabulary and unit-length TF-IDF weights of the rows of ``src`` (doc_id, label, comment).
WEIGHTS_SQL = f"""{terms_sql('src')},
  n AS (SELECT count(*)::DOUBLE AS n FROM src),
  vocab AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf, ln((1 + any_value(n)) / (1 + count(*))) + 1 AS idf
    FROM tf, n GROUP BY term HAVING count(*) >= 2 AND count(*) <= 0.95 * any_value(n) ORDER BY cf DESC, term LIMIT 20000),
  w AS (SELECT doc_id, label, term, (1 + ln(tf)) * idf AS w FROM tf JOIN vocab USING (term)),
  unit AS (SELECT doc_id, label, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w)"""
VOCAB_SQL = f"src AS ({b.LABELLED}), {WEIGHTS_SQL}"
NB_LEARNED_SQL = """
  v AS (SELECT count(*) AS v FROM vocab),
  grid AS (SELECT label, term FROM (SELECT DISTINCT label FROM src), vocab),
  sums AS (SELECT g.label, g.term, coalesce(sum(u.weight), 0) AS w FROM grid g
    LEFT JOIN unit u ON u.label = g.label AND u.term = g.term GROUP BY ALL),
  learned AS (SELECT label, term, ln((w + 1) / (sum(w) OVER (PARTITION BY label) + v)) AS log_prob FROM sums, v)"""
# Naive Bayes learned from ``src`` and applied to ``asked`` (doc_id, label, comment).
NB_SQL = f"""{WEIGHTS_SQL}, {NB_LEARNED_SQL}, {terms_sql('asked', 'q')},
  prior AS (SELECT label, ln(count(*)::DOUBLE / sum(count(*)) OVER ()) AS prior FROM src GROUP BY label),
  qw AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM qtf JOIN vocab USING (term)),
  qunit AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM qw),
  dots AS (SELECT q.doc_id, l.label, sum(q.weight * l.log_prob) AS s FROM qunit q JOIN learned l ON l.term = q.term GROUP BY ALL),
  scores AS (SELECT a.doc_id, p.label, p.prior + coalesce(x.s, 0) AS s, x.s IS NOT NULL AS known
    FROM asked a CROSS JOIN prior p LEFT JOIN dots x ON x.doc_id = a.doc_id AND x.label = p.label),
  shares AS (SELECT *, exp(s - max(s) OVER (PARTITION BY doc_id)) AS e FROM scores),
  answers AS (SELECT doc_id, arg_max(label, s) AS predicted, round(max(e) / sum(e), 4) AS confidence,
    bool_or(known) AS known FROM shares GROUP BY doc_id)"""


def nb_test_sql(train: str, test: str = "'test'") -> str:
    """Scores on one part of naive Bayes trained on the given parts."""
    split = SPLIT_SQL.replace("  src AS", "  all_rows AS").replace("FROM src", "FROM all_rows").replace("src.*", "all_rows.*")
    return f"""WITH {split}, src AS (SELECT doc_id, label, comment FROM split WHERE split IN ({train})),
      asked AS (SELECT doc_id, label, comment FROM split WHERE split = {test}), {NB_SQL},
      p AS (SELECT a.doc_id, a.label, x.predicted FROM asked a JOIN answers x ON x.doc_id = a.doc_id), {METRICS_FROM_P}
      SELECT %s round((SELECT count(*) FILTER (label = predicted)::DOUBLE / count(*) FROM p), 4) AS accuracy,
        round(avg(precision), 4) AS precision_macro, round(avg(recall), 4) AS recall_macro, round(avg(f1), 4) AS f1_macro,
        round(sum(precision * support) / sum(support), 4) AS precision_weighted,
        round(sum(recall * support) / sum(support), 4) AS recall_weighted,
        round(sum(f1 * support) / sum(support), 4) AS f1_weighted FROM m"""


def nb_predict_sql(rows: str, select: str) -> str:
    """Answers of naive Bayes trained on all labelled rows; ``rows`` is (doc_id, comment)."""
    return f"""WITH src AS ({b.LABELLED}), rows_in AS ({rows}),
      asked AS (SELECT doc_id, '' AS label, {b.sql_norm('comment')} AS comment FROM rows_in WHERE NOT {b.sql_empty('comment')}),
      {NB_SQL} SELECT {select} FROM rows_in r LEFT JOIN answers a ON a.doc_id = r.doc_id"""


@query(
    "tfidf_vocab",
    f"WITH {VOCAB_SQL} SELECT term, df, cf, n::BIGINT AS n_docs, round(idf, 6) AS idf FROM vocab, n",
)
def tfidf_vocab(spark, sf):
    vocab = features.tfidf_vocab(b.labelled(spark, sf))
    return vocab.withColumn("idf", F.round("idf", 6)).withColumn("n_docs", F.col("n_docs").cast("bigint"))


@query(
    "tfidf_weights",
    f"WITH {VOCAB_SQL} SELECT doc_id, term, round(weight, 6) AS weight FROM unit",
)
def tfidf_weights(spark, sf):
    rows = b.labelled(spark, sf)
    weights = features.tfidf_weights(rows, "doc_id", features.fit_vectorizer(rows))
    return weights.withColumn("weight", F.round("weight", 6))


@query(
    "idf_join",
    f"WITH {VOCAB_SQL} SELECT doc_id, term, CAST(tf AS INTEGER) AS tf, round(idf, 6) AS idf FROM tf JOIN vocab USING (term)",
)
def idf_join(spark, sf):
    rows = b.labelled(spark, sf)
    joined = features.idf_join(rows, "doc_id", features.tfidf_vocab(rows))
    return joined.withColumn("idf", F.round("idf", 6))


@query(
    "nb_log_probabilities",
    f"WITH {VOCAB_SQL}, {NB_LEARNED_SQL} SELECT label, term, round(log_prob, 6) AS log_prob FROM learned",
)
def nb_log_probabilities(spark, sf):
    rows = b.labelled(spark, sf)
    found = models.nb_log_probabilities(rows, features.fit_vectorizer(rows))
    return found.withColumn("log_prob", F.round("log_prob", 6))


def _split(spark, sf):
    return written(sampling.stratified_split(b.labelled(spark, sf), "doc_id")[0], "split", even=True)


def _held_out_scores(spark, sf, name):
    split = _split(spark, sf)
    model = models.fit_candidate(sampling.union_splits(split, "train", "val"), "doc_id", name)
    test = models.score(model, sampling.union_splits(split, "test"))
    return metrics.classification_metrics(test).select(F.lit(name).alias("model"), *metrics.SCORES)


@query("train_logreg")
def train_logreg(spark, sf):
    return _held_out_scores(spark, sf, "tfidf_logreg")


@query("train_linear_svm")
def train_linear_svm(spark, sf):
    return _held_out_scores(spark, sf, "tfidf_linear_svm")


@query("train_multinomial_nb", nb_test_sql("'train', 'val'") % "'tfidf_multinomial_nb' AS model,")
def train_multinomial_nb(spark, sf):
    return _held_out_scores(spark, sf, "tfidf_multinomial_nb")


GRID_SQL = f"""WITH {SPLIT_SQL.replace("  src AS", "  all_rows AS").replace("FROM src", "FROM all_rows").replace("src.*", "all_rows.*")},
  src AS (SELECT doc_id, label, comment FROM split WHERE split = 'train'),
  small AS (SELECT min(n) AS least FROM (SELECT count(*) AS n FROM src GROUP BY label)),
  folded AS (SELECT doc_id, CASE WHEN least >= 3 THEN ntile(3) OVER w ELSE ntile(2) OVER w END - 1 AS fold FROM src, small
    WINDOW w AS (PARTITION BY label ORDER BY md5('42:' || doc_id), doc_id)), {terms_sql('src')},
  outside AS (SELECT DISTINCT fold FROM folded),
  sizes_out AS (SELECT o.fold, count(*)::DOUBLE AS n FROM outside o JOIN folded f ON f.fold <> o.fold GROUP BY o.fold),
  seen AS (SELECT o.fold, t.term, count(*) AS df FROM tf t JOIN folded f USING (doc_id) JOIN outside o ON o.fold <> f.fold GROUP BY ALL),
  shapes AS (SELECT * FROM (VALUES (1), (2)) a(ngram_max), (VALUES (1), (2)) b(min_df), (VALUES (0.9::DOUBLE), (0.95::DOUBLE)) c(max_df))
  SELECT ngram_max, min_df, max_df, CAST(s.fold AS INTEGER) AS fold, CAST(any_value(n) AS BIGINT) AS n_docs, count(*) AS terms,
    round(sum(ln((1 + n) / (1 + df)) + 1), 3) AS idf_sum
  FROM seen s JOIN sizes_out USING (fold), shapes
  WHERE df >= min_df AND df <= max_df * n AND (ngram_max = 2 OR NOT contains(term, ' ')) GROUP BY ALL"""


@query("grid_features", GRID_SQL)
def grid_features(spark, sf):
    """The vocabulary of every shape and fold of the whole grid, before any model is fitted on it."""
    grid = models.grid_features(sampling.union_splits(_split(spark, sf), "train"), "doc_id", rules.GRID["ngram_max"])
    shapes = itertools.product(*(rules.GRID[n] for n in ("ngram_max", "min_df", "max_df")), range(len(grid.fold_sizes)))
    return grid.vocabulary_sizes(list(shapes)).withColumn("idf_sum", F.round("idf_sum", 3))


_GRIDS: dict = {}


def _grid(spark, sf):
    """Best parameters and all results of the default grid. Three queries need it, so a session searches once."""
    place = (spark.sparkContext.applicationId, sf)
    if place not in _GRIDS:
        best, results = models.grid_search(sampling.union_splits(_split(spark, sf), "train"), "doc_id")
        _GRIDS[place] = best, written(results, "grid")
    return _GRIDS[place]


def _selected(spark, sf):
    """The whole run: the grid, four candidates, the refit and one test; once per session as well."""
    place = (spark.sparkContext.applicationId, sf, "selection")
    if place not in _GRIDS:
        _GRIDS[place] = models.select_refit_test(b.labelled(spark, sf), "doc_id", params=_grid(spark, sf)[0])
    return _GRIDS[place]


@query("grid_search")
def grid_search(spark, sf):
    """All combinations of the default grid."""
    return _grid(spark, sf)[1]


def _compared(spark, sf):
    rows, info = sampling.stratified_split(b.labelled(spark, sf), "doc_id")
    rows = written(rows, "split", even=True)
    validation = sampling.union_splits(rows, "val") if info["val_size"] else None
    return models.compare_models(sampling.union_splits(rows, "train"), validation, "doc_id")


@query("compare_models")
def compare_models(spark, sf):
    return _compared(spark, sf)


@query("comparison_nb", nb_test_sql("'train'", "'test'") % "'tfidf_multinomial_nb' AS model,")
def comparison_nb(spark, sf):
    """The part of a comparison that SQL can follow: naive Bayes beside another candidate, judged on the test part."""
    split = _split(spark, sf)
    candidates = [models.Candidate(f"tfidf_{name}") for name in ("logreg", "multinomial_nb")]
    found = models.compare_models(
        sampling.union_splits(split, "train"), sampling.union_splits(split, "test"), "doc_id", candidates
    )
    return found.filter("model = 'tfidf_multinomial_nb'").select("model", *metrics.SCORES)


@query("select_refit_test")
def select_refit_test(spark, sf):
    chosen = _selected(spark, sf)
    return chosen.test_metrics.select(F.lit(chosen.name).alias("model"), *metrics.SCORES)


@query(
    "model_report",
    f"""WITH {SPLIT_SQL} SELECT 42::BIGINT AS random_state, n::BIGINT AS dataset_size_total, train::BIGINT AS train_size,
        (SELECT count(*) FROM src WHERE label = 'Negative') AS negative_rows, 4::BIGINT AS candidates FROM goal""",
)
def model_report(spark, sf):
    """The stored record of a whole run, read back; which candidate won is no matter for SQL."""
    chosen = _selected(spark, sf)
    path = work_folder(spark, "report") + ".json"
    models.save_report(models.model_report(spark, chosen), path)
    compared = F.get_json_object("candidate_comparison_on_eval_split", "$[*].candidate")
    return spark.read.json(path).select(
        "random_state",
        "dataset_size_total",
        F.get_json_object("split_info", "$.train_size").cast("bigint").alias("train_size"),
        F.get_json_object("dataset_class_distribution", "$.Negative").cast("bigint").alias("negative_rows"),
        F.json_array_length(compared).cast("bigint").alias("candidates"),
    )


@query(
    "min_rows_guard",
    f"SELECT count(*) AS usable FROM ({b.LABELLED}) l HAVING count(*) >= 30",
)
def min_rows_guard(spark, sf):
    rows = b.labelled(spark, sf)
    models.min_rows_guard(rows)
    return rows.agg(F.count("*").alias("usable"))


def _nb(spark, sf):
    return models.fit_candidate(b.labelled(spark, sf), "doc_id", "tfidf_multinomial_nb")


@query(
    "predict_batch",
    nb_predict_sql(
        f"SELECT doc_id, comment FROM ({b.MESSY}) m",
        "r.doc_id, r.comment, a.predicted AS predicted_sentiment, a.confidence, coalesce(a.known, false) AS known_vocabulary",
    ),
)
def predict_batch(spark, sf):
    rows = b.messy(spark, sf).select("doc_id", "comment")
    return scoring.predict_batch(rows, _nb(spark, sf), with_known=True)


@query(
    "predict_one",
    nb_predict_sql(
        "SELECT doc_id, text AS comment FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 1",
        "r.comment, a.predicted AS sentiment, a.confidence, a.known AS known_vocabulary, CAST(NULL AS VARCHAR) AS error",
    ),
)
def predict_one(spark, sf):
    row = sampling.random_comment(b.table(spark, sf, "documents").select("doc_id", "text"), "doc_id").first()
    answer = scoring.predict_one(spark, row["text"], _nb(spark, sf))
    return spark.createDataFrame(
        [answer],
        "comment string, sentiment string, confidence double, known_vocabulary boolean, error string",
    )


@query(
    "save_load_model",
    nb_predict_sql(
        "SELECT doc_id, text AS comment FROM documents", "r.doc_id, a.predicted AS predicted_sentiment, a.confidence"
    ),
)
def save_load_model(spark, sf):
    path = work_folder(spark, "model")
    models.save_model(_nb(spark, sf), path)
    rows = b.table(spark, sf, "documents").select("doc_id", F.col("text").alias("comment"))
    return scoring.predict_batch(rows, models.load_model(path)).drop("comment")


@query("evaluate_saved", nb_test_sql("'train'") % "")
def evaluate_saved(spark, sf):
    split = _split(spark, sf)
    path = work_folder(spark, "model")
    models.save_model(
        models.fit_candidate(sampling.union_splits(split, "train"), "doc_id", "tfidf_multinomial_nb"), path
    )
    found = models.evaluate_saved(path, sampling.union_splits(split, "test"))
    return found.select(*metrics.SCORES)


def keyword_labeler(text: str) -> str:
    """A stand-in for a model: answers in the ways the label parser has to cope with."""
    if len(text) % 11 == 0:
        raise ValueError("no answer")
    if "the" in text.lower():
        return "<think>maybe Negative</think> positive"
    return "It is Negative." if len(text) % 2 else "Positive or Neutral"


ANSWER_SQL = """CASE WHEN length(text) % 11 = 0 THEN NULL WHEN contains(lower(text), 'the') THEN 'Positive'
  WHEN length(text) % 2 = 1 THEN 'Negative' END"""


@query(
    "label_batch",
    f"""SELECT doc_id, sha256(text) AS text_sha, {ANSWER_SQL} AS label,
        CASE WHEN {ANSWER_SQL} IS NOT NULL THEN NULL WHEN length(text) % 11 = 0 THEN 'no answer'
          ELSE 'Invalid labeler output: Positive or Neutral' END AS error FROM documents""",
)
def label_batch(spark, sf):
    rows = labeling.hashed(b.table(spark, sf, "documents"), "doc_id", "text")
    good, failed = labeling.label_batch(rows, "doc_id", keyword_labeler)
    none = F.lit(None).cast("string")
    return good.select("doc_id", "text_sha", "label", none.alias("error")).unionByName(
        failed.select("doc_id", "text_sha", none.alias("label"), "error")
    )


@query(
    "label_backlog",
    f"""SELECT doc_id, {ANSWER_SQL} AS label FROM documents WHERE {ANSWER_SQL} IS NOT NULL""",
)
def label_backlog(spark, sf):
    """Two runs: the first stops at a limit, the second goes on where it stopped."""
    documents = b.table(spark, sf, "documents")
    folder = work_folder(spark, "labelling")
    half = documents.count() // 2
    labeling.label_backlog(documents, "doc_id", "text", keyword_labeler, folder, save_every=half, limit=half)
    labeling.label_backlog(documents, "doc_id", "text", keyword_labeler, folder, save_every=max(1, half // 2))
    return spark.read.parquet(f"{folder}/labelled.parquet").select("doc_id", "label")


@query(
    "label_rank",
    f"""SELECT doc_id, CAST(list_position(['Positive', 'Negative', 'Neutral'], label) - 1 AS INTEGER) AS rank
        FROM ({b.LABELLED}) l""",
)
def label_rank_query(spark, sf):
    return b.labelled(spark, sf).select("doc_id", label_rank("label").alias("rank"))
