"""The context document that shares most words with a question."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.functions.tokens import keyword_words
from commentlens.session import written

FREQUENT = 1000  # a word that more documents hold is frequent
TASK_MATCHES = 2_000_000  # equal words of two sides that one task puts together, about
SMALL_SIDE = 500_000  # rows of words that are sent to all tasks


def word_intersection(a, b):
    """Size of the intersection of two word arrays."""
    return F.size(F.array_intersect(a, b))


def _word_table(df: DataFrame, key: str, text: str, name: str) -> DataFrame:
    return df.select(
        F.col(key).alias(name), keyword_words(F.coalesce(F.col(text), F.lit(""))).alias("words")
    )


def _graded(table: DataFrame, name: str, held: DataFrame) -> DataFrame:
    """One row per word that documents hold, with their number."""
    return written(table.select(name, F.explode("words").alias("word")).join(held, "word"), "lookup")


def _frequent_sets(graded: DataFrame, name: str, frequent_from: int) -> DataFrame:
    """Each row's frequent words, the rarest first."""
    ordered = F.sort_array(F.collect_list(F.struct("held", "word")))
    sets = graded.filter(F.col("held") > frequent_from).groupBy(name).agg(ordered.alias("set"))
    return sets.select(name, F.col("set.word").alias("set"))


def _met(asked: DataFrame, library: DataFrame, by: str) -> DataFrame:
    """``by`` and ``document`` for each equal word, dealt by ``by`` over so many tasks that each gets a bounded number of matches.

    ``held`` of a row of ``asked`` is the number of its matches. What follows is grouped by ``by`` (and more), so it happens within
    the task: no pairs are shuffled where the library's words are few, and a task's pairs do not become more with the input.
    """
    matches = asked.agg(F.sum("held")).first()[0] or 0
    tasks = max(asked.sparkSession.sparkContext.defaultParallelism, -(-matches // TASK_MATCHES))
    asked, library = asked.select(by, "word"), library.select("document", "word")
    if library.count() <= SMALL_SIDE:
        return asked.repartition(tasks, by).join(F.broadcast(library), "word").drop("word")
    return asked.join(library, "word").drop("word").repartition(tasks, by)


def _best(scores: DataFrame, by: str) -> DataFrame:
    """The document with the highest score of each row, on a tie the smallest."""
    least = F.min(F.struct((-F.col("score")).alias("less"), "document")).alias("best")
    return scores.groupBy(by).agg(least).select(by, "best.document", (-F.col("best.less")).alias("score"))


def keyword_overlap_match(
    questions: DataFrame,
    question_key: str,
    question_text: str,
    documents: DataFrame,
    document_key: str,
    document_text: str,
    frequent_from: int = FREQUENT,
) -> DataFrame:
    """``(question, document, score)`` for every question; NULL and 0 where no word is shared.

    Documents that share a rare word with a question are found by a join on the rare words, so a word brings a
    question at most ``frequent_from`` documents; their scores add the frequent words that both hold. A document
    that shares no rare word has at most as many points as the question has frequent words, so only questions whose best so far does
    not exceed that are looked at again. For these, equal sets of frequent words are one on either side, and sets meet on
    the question's rarest frequent words alone: without one of these a document cannot reach the best. So a word that
    all rows hold makes no product of rows. Ties go to the smallest id. Keys are unique.
    """
    asked = _word_table(questions, question_key, question_text, "question")
    library = _word_table(documents, document_key, document_text, "document")
    held = library.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("held"))
    held = written(held, "lookup")
    asked, library = _graded(asked, "question", held), _graded(library, "document", held)
    asked_sets = _frequent_sets(asked, "question", frequent_from)
    library_sets = written(_frequent_sets(library, "document", frequent_from), "lookup")

    rare = _met(*(x.filter(F.col("held") <= frequent_from) for x in (asked, library)), "question")
    rare = rare.groupBy("question", "document").agg(F.count(F.lit(1)).alias("rare"))
    both = rare.join(asked_sets.withColumnRenamed("set", "a"), "question", "left")
    both = both.join(library_sets.withColumnRenamed("set", "b"), "document", "left")
    shared = F.coalesce(word_intersection("a", "b"), F.lit(0))
    first = written(_best(both.select("question", "document", (F.col("rare") + F.greatest(shared, F.lit(0))).alias("score")), "question"), "lookup")

    reached = F.coalesce("score", F.lit(0)).alias("reached")
    open_ = asked_sets.join(first, "question", "left").select("question", "set", reached).filter(F.col("reached") <= F.size("set"))
    kinds = open_.groupBy("set", "reached").agg(F.min("question").alias("kind"))
    needed = F.size("set") - F.greatest("reached", F.lit(1)) + 1
    left = kinds.select("kind", F.explode(F.slice("set", F.lit(1), needed.cast("int"))).alias("word"))
    lowest = library_sets.groupBy("set").agg(F.min("document").alias("document"))
    words = written(lowest.select("document", F.explode("set").alias("word")), "lookup")
    left = left.join(words.groupBy("word").agg(F.count(F.lit(1)).alias("held")), "word")
    met = _met(written(left, "lookup"), words, "kind").distinct()
    met = met.join(kinds.select("kind", F.col("set").alias("a")), "kind").join(lowest.withColumnRenamed("set", "b"), "document")
    again = _best(met.select("kind", "document", word_intersection("a", "b").cast("long").alias("score")), "kind")
    again = open_.join(kinds, ["set", "reached"]).select("question", "kind").join(again, "kind").select("question", "document", "score")

    found = _best(first.unionByName(again), "question")
    keys = questions.select(F.col(question_key).alias("question"))
    return keys.join(found, "question", "left").select(
        "question", "document", F.coalesce("score", F.lit(0)).alias("score")
    )
