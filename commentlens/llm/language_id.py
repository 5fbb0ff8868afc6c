"""Language identification by prediction by partial matching.

For each language a context tree over bytes counts what follows each context of up to three bytes. A byte's
probability comes from the longest context that was seen; what that context never saw is reached by an
escape (method C: as likely as the number of different bytes seen there) to the next shorter one, with
the bytes already ruled out excluded. The statistics are frozen after training, so the whole tree is
unfolded once into one table of code lengths, in bits, per (context, byte, language). Scoring a text is
then two lookups a byte for all languages at once, and its code lengths are exact.

The trees are learned from a sample of labelled rows: at most ``ROWS_PER_LANGUAGE`` different keys of each
language. That bounds the model, which is broadcast, whatever the size of the table. Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentlens.llm.common import byte_texts, leave_stores, plain, text_slices

ORDER = 3
ROWS_PER_LANGUAGE = 1000
LEAST_SEEN = 3  # rarer contexts of full length are left to their suffix
UNKNOWN = "und"
_CHUNK = 2048  # contexts unfolded at a time
_BITS = 9  # a symbol is 0 before the text, else byte + 1


def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as symbols, each after ``ORDER`` zeros, and the places where the texts themselves begin."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(lengths + ORDER) - lengths
    out = np.zeros(int((lengths + ORDER).sum()), np.int64)
    octets = np.frombuffer(b"".join(texts), np.uint8)
    inside = np.ones(len(out), bool)
    for i in range(1, ORDER + 1):
        inside[begins - i] = False
    out[inside] = octets.astype(np.int64) + 1
    return out, begins


def _windows(symbol: np.ndarray) -> np.ndarray:
    """The last ``ORDER`` symbols and the one after them as one number, at each place that has them."""
    code = np.zeros(len(symbol) - ORDER, np.int64)
    for i in range(ORDER + 1):
        code = (code << _BITS) | symbol[i : len(symbol) - ORDER + i]
    return code


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    leave_stores()
    for batch in text_slices(batches, 1):
        languages = np.array(batch.column(0).to_pylist())
        texts = byte_texts(batch, 1)
        for language in np.unique(languages):
            own, _ = symbols([texts[i] for i in np.flatnonzero(languages == language)])
            codes = _windows(own) if len(own) > ORDER else np.zeros(0, np.int64)
            codes = codes[(codes & ((1 << _BITS) - 1)) > 0]
            code, count = np.unique(codes, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(code), language), pa.int32()), pa.array(code), pa.array(count.astype(np.int64))],
                names=["language", "code", "n"],
            )


@dataclass(frozen=True)
class ContextTrees:
    """Unfolded trees. ``letter``: symbol to column; ``state``: last columns to row; ``bits``: [row, column, language]."""

    languages: list[str]
    letter: np.ndarray
    state: np.ndarray
    bits: np.ndarray

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language; an empty text takes none."""
        total = np.zeros((len(texts), len(self.languages)))
        some = [i for i, t in enumerate(texts) if t]
        if not some or not self.languages:
            return total
        symbol, begins = symbols([texts[i] for i in some])
        column = self.letter[symbol]
        wide = self.bits.shape[1]
        context = np.zeros(len(column) - ORDER, np.int64)
        for i in range(ORDER):
            context = context * wide + column[i : len(column) - ORDER + i]
        at = self.state[context].astype(np.int64) * wide + column[ORDER:]
        cost = np.take(self.bits.reshape(-1, len(self.languages)), at, axis=0)
        cost[symbol[ORDER:] == 0] = 0
        total[some] = np.add.reduceat(cost, begins - ORDER, axis=0, dtype=np.float64)
        return total


def unfold(languages: list[str], language: np.ndarray, code: np.ndarray, n: np.ndarray) -> ContextTrees:
    """The trees of all languages as one table, from counts of (``ORDER`` symbols, next symbol)."""
    mask = (1 << _BITS) - 1
    parts = [(code >> (_BITS * (ORDER - i))) & mask for i in range(ORDER + 1)]
    seen = np.unique(parts[ORDER])
    letter = np.full(257, len(seen) + 1, np.int64)  # the last column: any byte never seen
    letter[0] = 0
    letter[seen] = np.arange(1, len(seen) + 1)
    wide = len(seen) + 2
    columns = [letter[p] for p in parts]
    state = np.zeros(wide**ORDER, np.int32)
    layers: list[np.ndarray] = []
    below_context = np.zeros(1, np.int64)
    # Order 0 escapes to all 256 bytes alike.
    below = np.full((1, wide, len(languages)), 1 / 256, np.float32)
    for order in range(ORDER + 1):
        context = np.zeros(len(code), np.int64)
        for i in range(ORDER - order, ORDER):
            context = context * wide + columns[i]
        known, place = np.unique(context, return_inverse=True)
        if order == ORDER:
            known = known[np.bincount(place, weights=n) >= LEAST_SEEN]
        if not order:
            known = np.zeros(1, np.int64)
        parent = np.searchsorted(below_context, known % wide ** (order - 1)) if order else np.zeros(1, np.int64)
        out = np.empty((len(known), wide, len(languages)), np.float32)
        sort = np.argsort(context, kind="stable")
        edges = np.searchsorted(context[sort], known, "left"), np.searchsorted(context[sort], known, "right")
        for first in range(0, len(known), _CHUNK):
            rows = slice(first, min(first + _CHUNK, len(known)))
            own = sort[edges[0][rows.start] : edges[1][rows.stop - 1]]
            at = np.searchsorted(known[rows], context[own])
            hit = known[rows][np.minimum(at, rows.stop - first - 1)] == context[own]
            cell = at * wide + columns[ORDER][own]
            for k in range(len(languages)):
                some = hit & (language[own] == k)
                counts = np.bincount(cell[some], weights=n[own][some], minlength=(rows.stop - first) * wide)
                out[rows, :, k] = _mixed(counts.reshape(-1, wide), below[parent[rows], :, k])
        if order:
            state.reshape(-1, wide**order)[:, known] = sum(map(len, layers)) + np.arange(len(known))
        layers.append(out)
        below, below_context = out, known
    with np.errstate(divide="ignore"):
        bits = -np.log2(np.concatenate(layers))
    return ContextTrees(languages, letter, state, np.minimum(bits, 64, out=bits))


def _mixed(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Probabilities in contexts with these counts, given those of the next shorter contexts."""
    total, kinds = counts.sum(axis=1), (counts > 0).sum(axis=1)
    rest = 1 - np.where(counts > 0, below, 0).sum(axis=1, dtype=np.float64)
    none = rest <= 1e-6  # nothing is left to escape to
    whole = np.maximum(np.where(none, total, total + kinds), 1)
    escape = np.where(none, 0, kinds) / whole / np.where(none, 1, rest)
    mixed = np.where(counts > 0, counts / whole[:, None], below * escape[:, None])
    return np.where((total > 0)[:, None], mixed, below)


def learn(docs: DataFrame, label: str = "lang", key: str = "doc_id", text: str = "text", rows: int = ROWS_PER_LANGUAGE) -> ContextTrees:
    """Trees of each non-NULL value of ``label``, from the ``rows`` keys of each that come first by hash.

    Empty texts teach nothing. Rows that share a key count as one of the sample and are all learned.
    """
    labelled = docs.filter(F.col(label).isNotNull()).select(
        F.col(label).cast("string").alias("language"),
        F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("h"),
        F.col(text).cast("string").alias("text"),
    )
    labelled = labelled.filter("text != ''")
    keys = labelled.groupBy("language", "h").agg(F.count(F.lit(1)).alias("n"))
    first = keys.withColumn("at", F.row_number().over(Window.partitionBy("language").orderBy("h"))).filter(F.col("at") <= rows)
    last = {r["language"]: r["h"] for r in first.groupBy("language").agg(F.max("h").alias("h")).collect()}
    languages = sorted(last)
    if not languages:
        return ContextTrees([], np.zeros(257, np.int64), np.zeros(0, np.int32), np.zeros((0, 2, 0), np.float32))
    limit = F.create_map(*[F.lit(x) for name in languages for x in (name, last[name])])
    number = F.array_position(F.array(*[F.lit(name) for name in languages]), F.col("language")).cast("int") - 1
    sample = labelled.filter(F.col("h") <= limit[F.col("language")]).select(number.alias("language"), "text")
    counts = sample.mapInArrow(_counted, "language int, code long, n long").groupBy("language", "code").agg(F.sum("n").alias("n"))
    table = counts.toArrow()
    return unfold(languages, *(table.column(c).to_numpy() for c in ("language", "code", "n")))


def predict(docs: DataFrame, trees: ContextTrees, text: str = "text", carry: list[Column] | None = None) -> DataFrame:
    """``carry`` columns, then lang_pred, score (the language's share of 2^-bits) and bits_per_byte.

    A text that is NULL or holds no letter is ``und`` with score 0, and so is every text if no language was
    learned. Of languages with equal code length the first by name is taken. Only ``text`` is looked at; columns
    of the input that have the name of a result column are replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(plain(trees))
    body = F.col(text).cast("string")
    results = ("lang_pred", "score", "bits_per_byte")
    carried = F.struct(*(carry if carry is not None else [F.col(c) for c in docs.columns if c.lower() not in results]))
    slim = docs.select(body.alias("text"), F.coalesce(body.rlike(r"\p{L}"), F.lit(False)).alias("letters"), carried.alias("row"))
    out = slim.select("row").schema.add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double")
    arrow = to_arrow_schema(out)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_stores()
        trees = ContextTrees(*model.value)
        for batch in text_slices(batches, 0, most=500_000):
            texts = byte_texts(batch, 0)
            bits = trees.lengths(texts)
            known = np.array(batch.column(1).to_pylist(), bool) & bool(trees.languages)
            if trees.languages:
                best = bits.argmin(axis=1)
                low = bits.min(axis=1)
                share = 1 / np.exp2(np.maximum(low[:, None] - bits, -1000)).sum(axis=1)
                names = [trees.languages[i] if k else UNKNOWN for i, k in zip(best, known)]
                rate = low / np.maximum([len(t) for t in texts], 1)
            else:
                names, share, rate = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            columns = [batch.column(2), pa.array(names), pa.array(np.where(known, share, 0.0)), pa.array(rate)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return slim.mapInArrow(score, out).select("row.*", "lang_pred", "score", "bits_per_byte")


def keep_identified(docs: DataFrame, trees: ContextTrees, text: str = "text", accepted: list[str] | None = None) -> DataFrame:
    """The rows, with their own columns, whose language is known and, if ``accepted`` is given, named there."""
    found = predict(docs, trees, text, [F.struct(*docs.columns).alias("row")])
    kept = found.filter(F.col("lang_pred") != UNKNOWN)
    if accepted is not None:
        kept = kept.filter(F.col("lang_pred").isin(accepted))
    return kept.select("row.*")
