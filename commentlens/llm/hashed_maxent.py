"""A hashed maximum-entropy language model with a class-factored softmax.

The model says P(word | history) = P(class | history) * P(word | class). Classes are bands of the vocabulary, cut
so that each holds the same share of square-rooted counts: the most frequent words are classes of their own. The
class factor is a softmax over the sum of weight vectors that hashed features of the history select: the word
before, the pair before, the word before that (a skip feature), and a bias. Within a class the maximum-entropy solution
for word counts is their share, so those weights need no iteration.

All words of the training rows are counted. The model's own vocabulary is the most frequent ones, at most
``VOCABULARY``; all others form one class, whose members, a word never seen among them, have probabilities by
smoothed counts. Texts meet those counts by a join, since they do not fit a broadcast.

Weights are learned by gradient steps on the executors. Each round takes its share of all training rows, so every
row is used once; a task starts from the broadcast weights, takes its steps in small batches, and returns
what changed with how often each feature was met. These are averaged by feature, again on the executors, and only
the finished table, of fixed size, comes back to the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.llm.common import byte_texts, plain, text_slices
from commentlens.session import written

VOCABULARY = 131_072
CLASSES = 48  # the last is that of all other words
FEATURES = 1 << 15  # weight vectors that features are hashed to, for each of the three kinds together
ROUNDS = 3
BATCH = 8192  # words of a gradient step
RATE = 0.8
PART = 1024  # weight vectors in one row of the exchange
END = b"\n"  # no word holds white space


@dataclass(frozen=True)
class Model:
    """``known``: word to rank; ``class_of``, ``share``: of each rank, the last for all other words."""

    known: dict[bytes, int]
    class_of: np.ndarray
    share: np.ndarray  # log10 P(word | class)
    counts: np.ndarray  # of each rank
    weights: np.ndarray  # [feature, class]
    bias: np.ndarray

    @property
    def other(self) -> int:
        return len(self.class_of) - 1


def classes(counts: np.ndarray, most: int) -> np.ndarray:
    """The class of each of the words, most frequent first: equal shares of the square roots of counts."""
    root = np.sqrt(counts.astype(np.float64))
    if not len(root):
        return np.zeros(0, np.int64)
    place = (np.cumsum(root) - root / 2) / root.sum()
    return np.unique((place * (most - 1)).astype(np.int64).clip(0, most - 2), return_inverse=True)[1]


def start(words: list[bytes], counts: np.ndarray, others: int) -> Model:
    """The model before training: classes by their counts. ``others``: tokens of all other words."""
    band = classes(counts, CLASSES)
    count = int(band.max()) + 1 if len(band) else 0
    mass = np.bincount(band, weights=counts, minlength=count)
    share = np.log10(counts / mass[band]) if len(band) else np.zeros(0)
    total = np.append(mass, others) + 0.5
    return Model(
        dict(zip(words, range(len(words)))),
        np.append(band, count),
        np.append(share, 0.0),
        counts,
        np.zeros((FEATURES, count + 1), np.float32),
        np.log(total / total.sum()).astype(np.float32),
    )


def tokens(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Ranks of all texts' words, each text closed by the end; the number of each text; the words."""
    split = [[*t.lower().split(), END] for t in texts]
    words = [w for s in split for w in s]
    get, other = model.known.get, model.other
    ranks = np.fromiter((get(w, other) for w in words), np.int64, len(words))
    return ranks, np.fromiter(map(len, split), np.int64, len(split)), words


def histories(ranks: np.ndarray, counts: np.ndarray, other: int) -> list[np.ndarray]:
    """The three features of each word's history, hashed; before a text stand two marks."""
    begins = np.cumsum(counts) - counts
    mark = other + 1
    one = np.concatenate([[mark], ranks[:-1]])
    two = np.concatenate([[mark, mark], ranks[:-2]])[: len(ranks)]
    one[begins] = mark
    two[begins] = mark
    two[begins[counts > 1] + 1] = mark
    out = []
    for kind, value in ((1, one), (2, one * (mark + 1) + two), (3, two)):
        x = (value.astype(np.uint64) + np.uint64(kind << 40)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        out.append((x >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.uint16))
    return out


def log_shares(weights: np.ndarray, bias: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
    """ln P(class | history), one row per word."""
    score = np.take(weights, features[0], axis=0)
    for feature in features[1:]:
        score += np.take(weights, feature, axis=0)
    score += bias
    score -= score.max(axis=1, keepdims=True)
    return score - np.log(np.exp(score).sum(axis=1, keepdims=True))


class Learner:
    """Gradient steps from given weights, with a step size per feature that falls as its gradients add up."""

    def __init__(self, model: Model, rate: float):
        self.weights, self.bias, self.rate = model.weights.copy(), model.bias, rate
        self.energy = np.full(len(self.weights), 1e-8, np.float32)
        self.met = np.zeros(len(self.weights), np.int64)

    def step(self, features: list[np.ndarray], target: np.ndarray) -> None:
        slope = np.exp(log_shares(self.weights, self.bias, features))
        slope[np.arange(len(target)), target] -= 1
        for feature in features:
            order = np.argsort(feature, kind="stable")
            here = feature[order]
            first = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]]))
            which = here[first]
            count = np.diff(np.append(first, len(here)))
            total = np.add.reduceat(slope[order], first, axis=0)
            self.energy[which] += np.einsum("ij,ij->i", total, total)
            self.weights[which] -= self.rate * total / np.sqrt(self.energy[which])[:, None]
            self.met[which] += count


def _texts(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in text_slices(batches, column, most=1_000_000):
        yield batch, byte_texts(batch, column)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def taken() -> pa.RecordBatch:
        words = pa.array(list(held.keys()), pa.binary()).cast(pa.string())
        counts = pa.array(list(held.values()), pa.int64())
        held.clear()
        return pa.RecordBatch.from_arrays([words, counts], names=["word", "n"])

    for _, texts in _texts(batches, 0):
        for text in texts:
            held.update(text.lower().split())
        held[END] += len(texts)
        if len(held) > 400_000:
            yield taken()
    if held:
        yield taken()


def _learned(batches: Iterable[pa.RecordBatch], model: Model, rate: float) -> Iterator[pa.RecordBatch]:
    learner = Learner(model, rate)
    for _, texts in _texts(batches, 0):
        ranks, counts, _ = tokens(model, texts)
        features, target = histories(ranks, counts, model.other), model.class_of[ranks]
        for a in range(0, len(ranks), BATCH):
            learner.step([f[a : a + BATCH] for f in features], target[a : a + BATCH])
    change = (learner.weights - model.weights).astype(np.float16)
    for part, a in enumerate(range(0, FEATURES, PART)):
        met = learner.met[a : a + PART]
        if met.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([met.tobytes()]), pa.array([change[a : a + PART].tobytes()])],
                names=["part", "met", "change"],
            )


def _averaged(batches: Iterable[pa.RecordBatch], classes_: int) -> Iterator[pa.RecordBatch]:
    """The tasks' changes, each weighed by how often its task met the feature."""
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for part, met, change in zip(*(c.to_pylist() for c in batch.columns)):
            times = np.frombuffer(met, np.int64)
            total, often = sums.setdefault(part, (np.zeros((PART, classes_)), np.zeros(PART)))
            total += np.frombuffer(change, np.float16).reshape(PART, classes_) * times[:, None].astype(np.float64)
            often += times
    for part, (total, often) in sums.items():
        mean = (total / np.maximum(often, 1)[:, None]).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([mean.tobytes()])], names=["part", "change"])


@dataclass(frozen=True)
class Trained:
    """A model with what it needs beside the broadcast: counts of all words and their sums."""

    model: Model
    counts: DataFrame  # word, n of the words outside the model's vocabulary
    tokens: int  # all training tokens
    words: int  # different ones
    other_tokens: int
    other_words: int


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """word, n: of all lower-cased words of all texts, and of the ends; written."""
    slim = docs.select(F.col(text).cast("string").alias("text"))
    counted = slim.mapInArrow(_counted, "word string, n long")
    return written(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Trained:
    """A model of all rows. A NULL text is only its end; without rows every word is one never seen."""
    spark = docs.sparkSession
    counts = count_words(docs, text)
    # The vocabulary is cut between bands of counts, of which there are at most 64 times 64.
    band = F.floor(F.log2("n") * 64)
    bands = counts.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens")).collect()
    cut, taken = 64 * 64, 0
    for row in sorted(bands, key=lambda r: -r["band"]):
        if taken + row["words"] > VOCABULARY:
            break
        cut, taken = row["band"], taken + row["words"]
    top = counts.filter(band >= cut).orderBy(F.desc("n"), "word").collect()
    words, total = sum(r["words"] for r in bands), sum(r["tokens"] for r in bands)
    others = total - sum(r["n"] for r in top)
    model = start([r["word"].encode() for r in top], np.array([r["n"] for r in top], np.int64), others)

    share = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(ROUNDS))
    for turn in range(ROUNDS if top else 0):
        sent = spark.sparkContext.broadcast(plain(model))
        slim = docs.filter(share == turn).select(F.col(text).cast("string").alias("text"))
        wide = len(model.bias)
        steps = slim.mapInArrow(lambda b, sent=sent: _learned(b, Model(*sent.value), RATE), "part int, met binary, change binary")
        parts = steps.repartition("part").mapInArrow(lambda b, wide=wide: _averaged(b, wide), "part int, change binary").collect()
        weights = model.weights.copy()
        for row in parts:
            a = row["part"] * PART
            weights[a : a + PART] += np.frombuffer(row["change"], np.float32).reshape(PART, wide)
        model = Model(model.known, model.class_of, model.share, model.counts, weights, model.bias)
        sent.unpersist()
    return Trained(model, counts.filter(band < cut), total, words, others, words - len(top))


SCORED = "row long, key {kind}, n_tokens long, known long, base double, score double, others array<string>"


def _scored(batches: Iterable[pa.RecordBatch], model: Model, scale: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    base = np.append(np.log10((model.counts + 1) / scale), 0.0)
    part, number = TaskContext.get().partitionId(), 0
    for batch, texts in _texts(batches, 1):
        ranks, counts, words = tokens(model, texts)
        features, target = histories(ranks, counts, model.other), model.class_of[ranks]
        found = np.empty(len(ranks))
        for a in range(0, len(ranks), BATCH):
            cut = slice(a, a + BATCH)
            shares = log_shares(model.weights, model.bias, [f[cut] for f in features])
            found[cut] = shares[np.arange(len(shares)), target[cut]]
        found = found / np.log(10) + model.share[ranks]
        begins = np.cumsum(counts) - counts
        unknown = ranks == model.other
        several = np.add.reduceat(unknown, begins, dtype=np.int64)
        left = [words[i] for i in np.flatnonzero(unknown).tolist()]
        listed = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(several)]), pa.int32()), pa.array(left, pa.binary()).cast(pa.string())
        )
        rows = (part << 33) + number + np.arange(len(texts))
        number += len(texts)
        values = [rows, batch.column(0), counts, counts - several, np.add.reduceat(base[ranks], begins), np.add.reduceat(found, begins)]
        columns = [v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(values, schema)]
        yield pa.RecordBatch.from_arrays([*columns, listed], schema=schema)


def score(docs: DataFrame, trained: Trained, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, n_known, train_tokens, base_score and score of each row, as log10 probabilities.

    Texts are scored whole, lower-cased in A-Z, with one end each; a NULL text is only its end. ``base_score`` is that of
    the smoothed counts alone. Rows are scored each for itself, also if they repeat; only key and text are read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    sent = docs.sparkSession.sparkContext.broadcast(plain(trained.model))
    schema = SCORED.format(kind=docs.schema[key].dataType.simpleString())
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    scale = trained.tokens + trained.words + 1
    slim = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = written(slim.mapInArrow(lambda b: _scored(b, Model(*sent.value), scale, arrow), schema), "scores")

    others = rows.select("row", F.explode("others").alias("word")).join(trained.counts, "word", "left")
    count = F.coalesce("n", F.lit(0))
    inside = trained.other_tokens + trained.other_words + 1
    sums = others.groupBy("row").agg(
        F.count("n").alias("more_known"),
        F.sum(F.log10((count + 1) / scale)).alias("more_base"),
        F.sum(F.log10((count + 1) / inside)).alias("more_score"),
    )
    joined = rows.drop("others").join(sums, "row", "left")
    return joined.select(
        "key",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(trained.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
