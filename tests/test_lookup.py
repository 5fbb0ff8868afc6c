"""Questions meet documents in tasks of a bounded size."""

import re

from pyspark.sql import functions as F

from commentlens.operators import lookup


def test_matches_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(lookup, "TASK_MATCHES", 100, raising=False)
    monkeypatch.setattr(lookup, "written", keep := Kept())
    words = "alpha beta gamma delta".split()
    questions = spark.range(200).select(F.col("id").alias("q"), F.lit(" ".join(words)).alias("t"))
    documents = spark.range(20).select("id", F.concat_ws(" ", *map(F.lit, words[:3]), F.concat(F.lit("own"), "id")).alias("t"))
    for small in (500_000, 0):
        monkeypatch.setattr(lookup, "SMALL_SIDE", small, raising=False)
        keep.plans.clear()
        found = lookup.keyword_overlap_match(questions, "q", "t", documents, "id", "t").collect()
        assert sorted(map(tuple, found)) == [(q, 0, 3) for q in range(200)]
        # 200 questions x 3 words x 20 documents in hundreds; then no pair leaves its task.
        scored = next(p for p in keep.plans if "hashpartitioning(question" in p)
        assert ", 120)" in scored and "hashpartitioning(document" not in scored
        assert not re.search(r"hashpartitioning\(question#\d+L?, document", scored)


class Kept:
    """``written`` that keeps the plans."""

    def __init__(self):
        self.plans = []

    def __call__(self, df, purpose, even=False):
        from commentlens.session import written

        self.plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, purpose, even)
