"""Evaluation of predictions. One pass, one global aggregate, no shuffle of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentlens import rules

SCORES = [
    "accuracy",
    "precision_macro",
    "recall_macro",
    "f1_macro",
    "precision_weighted",
    "recall_weighted",
    "f1_weighted",
]


CLASSES = range(len(rules.LABELS))


def _tallies(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Every count the scores need: rows, hits, rows per label and per prediction, cells."""
    counts = {"n": "true", "hits": "t = p"}
    for i, label in enumerate(rules.LABELS):
        counts[f"true{i}"] = f"t = '{label}'"
        counts[f"pred{i}"] = f"p = '{label}'"
        for j, other in enumerate(rules.LABELS):
            counts[f"cell{i}_{j}"] = f"t = '{label}' AND p = '{other}'"
    pairs = df.select(F.col(true).alias("t"), F.col(predicted).alias("p"))
    return pairs.agg(*[F.expr(f"count_if({rule}) AS {name}") for name, rule in counts.items()])


def confusion_matrix(df: DataFrame, true: str = "label", predicted: str = "predicted") -> DataFrame:
    """``(true_label, predicted_label, n)`` for every pair of labels, zeros included."""
    cells = [
        F.struct(
            F.lit(a).alias("true_label"),
            F.lit(b).alias("predicted_label"),
            F.col(f"cell{i}_{j}").alias("n"),
        )
        for i, a in enumerate(rules.LABELS)
        for j, b in enumerate(rules.LABELS)
    ]
    return _tallies(df, true, predicted).select(F.inline(F.array(*cells)))


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN {part} / {whole} ELSE 0D END"


def classification_metrics(
    df: DataFrame, true: str = "label", predicted: str = "predicted", digits: int = 4
) -> DataFrame:
    """One row: accuracy, macro and weighted scores, per-class scores, confusion matrix."""
    per_class = []
    for i in CLASSES:
        hit, named, support = f"cell{i}_{i}", f"pred{i}", f"true{i}"
        per_class += [
            f"{_ratio(hit, named)} AS precision{i}",
            f"{_ratio(hit, support)} AS recall{i}",
            f"{_ratio(f'2 * {hit}', f'({named} + {support})')} AS f1{i}",
        ]
    support = "(" + " + ".join(f"true{i}" for i in CLASSES) + ")"
    columns = [f"round({_ratio('hits', 'n')}, {digits}) AS accuracy"]
    for score in ("precision", "recall", "f1"):
        total = " + ".join(f"{score}{i}" for i in CLASSES)
        columns.append(f"round(({total}) / {len(CLASSES)}, {digits}) AS {score}_macro")
    for score in ("precision", "recall", "f1"):
        total = " + ".join(f"{score}{i} * true{i}" for i in CLASSES)
        columns.append(f"round({_ratio(f'({total})', support)}, {digits}) AS {score}_weighted")
    entries = [
        f"'{label}', named_struct('precision', round(precision{i}, {digits}), "
        f"'recall', round(recall{i}, {digits}), 'f1', round(f1{i}, {digits}), 'support', true{i})"
        for i, label in enumerate(rules.LABELS)
    ]
    matrix = ", ".join(f"array({', '.join(f'cell{i}_{j}' for j in CLASSES)})" for i in CLASSES)
    columns += [f"map({', '.join(entries)}) AS per_class", f"array({matrix}) AS confusion_matrix"]
    return _tallies(df, true, predicted).selectExpr("*", *per_class).selectExpr(*columns)


def class_table(metrics: DataFrame) -> DataFrame:
    """The per-class part of a metrics row as ``(label, precision, recall, f1, support)``."""
    rows = [
        F.struct(F.lit(x).alias("label"), F.col("per_class")[x].alias("m")) for x in rules.LABELS
    ]
    return metrics.select(F.inline(F.array(*rows))).select("label", "m.*")


def classification_report(
    df: DataFrame, true: str = "label", predicted: str = "predicted"
) -> DataFrame:
    """Per-class lines, accuracy and averages as formatted text, in reading order."""
    m = classification_metrics(df, true, predicted, digits=10)
    total = sum((F.col("per_class")[x]["support"] for x in rules.LABELS), F.lit(0))
    line = "%12s %9.2f %9.2f %9.2f %9d"
    lines = [F.lit("%12s %9s %9s %9s %9s" % ("", "precision", "recall", "f1-score", "support"))]
    for label in rules.LABELS:
        c = F.col("per_class")[label]
        lines.append(
            F.format_string(line, F.lit(label), c["precision"], c["recall"], c["f1"], c["support"])
        )
    lines.append(
        F.format_string("%12s %9s %9s %9.2f %9d", F.lit("accuracy"), F.lit(""), F.lit(""), "accuracy", total)
    )
    for kind in ("macro", "weighted"):
        scores = [F.col(f"{s}_{kind}") for s in ("precision", "recall", "f1")]
        lines.append(F.format_string(line, F.lit(f"{kind} avg"), *scores, total))
    return m.select(F.posexplode(F.array(*lines)).alias("line", "text"))


def rank_models(results: DataFrame) -> DataFrame:
    """Best candidates first: macro F1, weighted F1, accuracy; earlier candidate on a full tie."""
    return results.orderBy(
        F.desc("f1_macro"), F.desc("f1_weighted"), F.desc("accuracy"), F.asc("candidate")
    )


def display_model_name(c: str) -> Column:
    titles = F.create_map(*[F.lit(x) for pair in rules.MODEL_TITLES.items() for x in pair])
    return F.coalesce(F.try_element_at(titles, F.col(c)), F.col(c))


def comparison_table(results: DataFrame) -> DataFrame:
    """Candidates as shown to a reader, best macro F1 first."""
    return results.select(
        display_model_name("model").alias("model"),
        "accuracy",
        F.col("f1_macro").alias("macro_f1"),
        F.col("f1_weighted").alias("weighted_f1"),
    ).orderBy(F.desc("macro_f1"))


def unpivot_metrics(table: DataFrame) -> DataFrame:
    scores = [c for c in table.columns if c != "model"]
    return table.unpivot("model", scores, "metric", "score")
