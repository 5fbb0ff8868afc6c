"""TF-IDF features: sublinear term frequency, smooth idf, unit length."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentlens import rules
from commentlens.functions.tokens import term_counts, tokenize_tfidf
from commentlens.session import written


def term_table(df: DataFrame, ngram_max: int = rules.NGRAM_MAX, keep: list[str] = ()) -> DataFrame:
    """``(…, term, tf)``: terms are counted inside each row, so nothing is shuffled by document."""
    counted = df.select(*keep, F.explode(term_counts(tokenize_tfidf("comment", ngram_max))).alias("t"))
    return counted.select(*keep, "t.term", "t.tf")


def term_totals(df: DataFrame, terms: Column, part: Column | None = None) -> DataFrame:
    """``(term, df, cf)`` over all rows, and ``part_df`` and ``part_cf`` over those of the ``part``, from one cut of the texts.

    A text's terms are followed by its different ones: places among the first add to the total count, the others to the
    document frequency. Each task adds up its own terms before anything is shuffled.
    """
    cut = df.select(terms.alias("terms"), (F.lit(True) if part is None else part).alias("inside"))
    both = F.posexplode(F.concat("terms", F.array_distinct("terms"))).alias("at", "term")
    marks = cut.select("inside", F.size("terms").alias("size"), both)
    seen, tf = (F.col("at") >= F.col("size")).cast("int"), (F.col("at") < F.col("size")).cast("int")
    sums = {"df": seen, "cf": tf}
    if part is not None:
        sums |= {f"part_{name}": F.when(F.col("inside"), mark).otherwise(0) for name, mark in (("df", seen), ("cf", tf))}
    return marks.groupBy("term").agg(*[F.sum(mark).alias(name) for name, mark in sums.items()])


def top_terms(counts: DataFrame, frequency: str, n: int | None) -> DataFrame:
    """The ``n`` most frequent terms of a written table of counts (all without ``n``); equal ones in term order.

    A histogram over the magnitude of the frequencies shows below which value no term can be among
    them, so that not every task has to send ``n`` candidates.
    """
    if n is None:
        return counts.orderBy(F.desc(frequency), "term")
    step = F.floor(F.log2(frequency) * 8).alias("step")
    steps = counts.groupBy(step).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect()
    found, least = 0, 0.0
    for r in steps:  # eight steps per doubling: some hundreds of rows at most
        found, least = found + r["n"], 2.0 ** (r["step"] / 8 - 0.01)
        if found >= n:
            break
    return counts.filter(F.col(frequency) >= least).orderBy(F.desc(frequency), "term").limit(n)


def tfidf_vocab(
    df: DataFrame,
    ngram_max: int = rules.NGRAM_MAX,
    min_df: int = rules.MIN_DF,
    max_df: float = rules.MAX_DF,
    max_features: int | None = rules.MAX_FEATURES,
    n_docs: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """``(term, df, cf, n_docs, idf)`` of the terms kept: the most frequent ones within the bounds.

    ``counts``: a written table with the ``term_totals`` of ``df``, if they are known.
    """
    n_docs = df.count() if n_docs is None else n_docs
    totals = term_totals(df, tokenize_tfidf("comment", ngram_max)) if counts is None else counts
    kept = totals.filter((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs))
    top = top_terms(written(kept, "terms") if counts is None else kept, "cf", max_features)
    return top.select("term", "df", "cf", F.lit(n_docs).alias("n_docs"), idf(F.col("df"), n_docs).alias("idf"))


def idf(document_frequency: Column, n_docs: int) -> Column:
    return F.log((1.0 + n_docs) / (1 + document_frequency)) + 1


class TfidfTokens(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Text to an array of 1- to n-grams."""

    ngramMax = Param(Params._dummy(), "ngramMax", "longest n-gram", TypeConverters.toInt)

    def __init__(self, inputCol: str = "comment", outputCol: str = "terms", ngramMax: int = 2):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, ngramMax=ngramMax)

    def _transform(self, df: DataFrame) -> DataFrame:
        terms = tokenize_tfidf(self.getInputCol(), self.getOrDefault(self.ngramMax))
        return df.withColumn(self.getOutputCol(), terms)


class SublinearTf(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """``1 + ln tf`` on a sparse count vector."""

    def __init__(self, inputCol: str = "counts", outputCol: str = "damped"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), damp(F.col(self.getInputCol())))


@F.arrow_udf(VectorUDT())
def _damped(parts: pa.Array) -> pa.Array:
    counts = parts.field("values")
    damped = pa.ListArray.from_arrays(counts.offsets, pc.add(1.0, pc.ln(counts.values)), type=counts.type)
    kind = pc.fill_null(parts.field("type"), 0)  # the field may not be NULL, not even where the vector is
    columns = [kind, parts.field("size"), parts.field("indices"), damped]
    return pa.StructArray.from_arrays(columns, fields=list(parts.type), mask=parts.is_null())


def damp(counts: Column) -> Column:
    """The vector with each count damped; NULL stays NULL.

    No built-in function or transformer takes a logarithm of a sparse vector or builds one from its parts, so the
    parts travel as an Arrow struct, whose values are one flat array for the whole batch.
    """
    return _damped(F.unwrap_udt(counts))


def count_vectorizer(terms: list[str]) -> CountVectorizerModel:
    """``CountVectorizerModel.from_vocabulary``, with the terms handed over in one call.

    That method makes one call per term, which takes seconds for the default vocabulary. No term
    holds a line feed.
    """
    jvm = SparkContext._active_spark_context._jvm
    vocabulary = jvm.java.util.regex.Pattern.compile("\n").split("\n".join(terms))
    model = CountVectorizerModel._create_from_java_class(
        "org.apache.spark.ml.feature.CountVectorizerModel", vocabulary
    )
    return model.setInputCol("terms").setOutputCol("counts")


def vectorizer(vocab: list[tuple[str, float]], ngram_max: int = rules.NGRAM_MAX) -> PipelineModel:
    """``comment`` to ``features``, for a vocabulary of (term, idf) in index order."""
    terms = [t for t, _ in vocab]
    return PipelineModel(
        [
            TfidfTokens(ngramMax=ngram_max),
            count_vectorizer(terms),
            SublinearTf(),
            ElementwiseProduct(
                scalingVec=Vectors.dense([w for _, w in vocab]), inputCol="damped", outputCol="weighted"
            ),
            Normalizer(p=2.0, inputCol="weighted", outputCol="features"),
        ]
    )


SCRATCH = ["terms", "counts", "damped", "weighted"]


def fit_vectorizer(df: DataFrame, **bounds) -> PipelineModel:
    """A vectorizer for the vocabulary of ``df``, which ``max_features`` and the number of rows bound."""
    rows = tfidf_vocab(df, **bounds).collect()
    if not rows:
        raise ValueError("no term lies within the document-frequency bounds")
    ngram_max = bounds.get("ngram_max", rules.NGRAM_MAX)
    return vectorizer([(r["term"], r["idf"]) for r in rows], ngram_max)


def vocabulary_of(model: PipelineModel) -> list[str]:
    return next(s for s in model.stages if isinstance(s, CountVectorizerModel)).vocabulary


def scaled_counts(model: PipelineModel) -> list:
    """Stages from ``comment`` to ``counts``, and to ``weighted``, which is the counts times idf, not yet damped: no Python."""
    tokens, counts = model.stages[:2]
    scale = next(s for s in model.stages if isinstance(s, ElementwiseProduct)).getScalingVec()
    return [tokens, counts, ElementwiseProduct(scalingVec=scale, inputCol="counts", outputCol="weighted")]


def vector_values(vector: str) -> Column:
    return F.unwrap_udt(vector)["values"]


def damping(counts: str) -> Column:
    """What turns each value of a multiple of ``counts`` into that multiple of the damped counts."""
    return F.transform(vector_values(counts), lambda n: (F.log(n) + 1) / n)


def times(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def length(values: Column) -> Column:
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x))


def tall_weights(df: DataFrame, keep: list[str], model: PipelineModel) -> DataFrame:
    """``(…, index, weight)``: the features in tall form, by the term's number in the vocabulary."""
    rows = PipelineModel(scaled_counts(model)).transform(df)
    rows = rows.select(*keep, F.unwrap_udt("counts")["indices"].alias("_at"), times(vector_values("weighted"), damping("counts")).alias("_values"))
    rows = rows.withColumn("_length", length(F.col("_values")))
    tall = rows.select(*keep, "_length", F.inline(F.arrays_zip(F.col("_at").alias("index"), F.col("_values").alias("_value"))))
    return tall.select(*keep, "index", (F.col("_value") / F.col("_length")).alias("weight"))


def numbered_terms(df: DataFrame, model: PipelineModel) -> DataFrame:
    """``(index, term)`` of the vocabulary, which the driver and each task that makes features hold anyway."""
    return F.broadcast(df.sparkSession.createDataFrame(list(enumerate(vocabulary_of(model))), "index int, term string"))


def tfidf_weights(df: DataFrame, key: str, model: PipelineModel) -> DataFrame:
    """``(key, term, weight)``: the features in tall form."""
    return tall_weights(df, [key], model).join(numbered_terms(df, model), "index").select(key, "term", "weight")


def idf_join(df: DataFrame, key: str, vocab: DataFrame, ngram_max: int = rules.NGRAM_MAX) -> DataFrame:
    """Each document's known terms with their idf. Spark broadcasts a vocabulary that it has found small enough."""
    terms = term_table(df, ngram_max, [key])
    return terms.join(vocab.select("term", "idf"), "term").select(key, "term", "tf", "idf")


def known_vocabulary(features: Column) -> Column:
    """False where no word of the text is known: the label then only reflects the class balance."""
    return F.size(F.unwrap_udt(features)["indices"]) > 0


def class_weights(sizes: dict[str, int]) -> dict[str, float]:
    """``balanced``: rows / (classes · rows of the class)."""
    total = sum(sizes.values())
    return {c: total / (len(sizes) * n) for c, n in sizes.items()}


def class_weight_join(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Each row with the weight of its class."""
    table = df.sparkSession.createDataFrame(list(weights.items()), "label string, class_weight double")
    return df.join(F.broadcast(table), "label")
