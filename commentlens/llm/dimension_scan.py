"""Approximate nearest neighbours by adaptive dimension scan over inverted lists.

Every vector is scaled to length one and belongs to the list of its nearest centroid. A query probes the lists whose
centroids are nearest. In a list the vectors are rotated by a random orthogonal matrix and lie in blocks
of columns. After a rotation any block of columns is a fair sample of all of them, so the distance over the first d
of D columns, times D / d, estimates the whole distance, and a hypothesis test abandons a candidate as soon as
its estimate is beyond the query's k-th best by more than the estimate's error allows. What is left after the last
block is scored on the original vectors in double precision.

Centroids and the number of probes come from a bounded sample (``SAMPLE`` vectors): probes are as many as
the sample's own neighbours need for ``recall``. Against that sample each query also gets its first bound,
so the scan abandons from the first candidate on. All vectors are indexed; equal vectors are one entry with their
``k + 1`` smallest ids, more of which no answer can need. Lists are split into blocks of bounded size on both sides.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentlens.llm.common import plain

SAMPLE = 20_000  # vectors that centroids, probes and first bounds are taken from
LIST_SIZE = 800  # vectors per list aimed at ...
MOST_LISTS = 4096  # ... with no more lists than this
ROUNDS = 8
COLUMNS = 16  # of a block
ERROR = 2.1  # of the hypothesis test: abandoned wrongly with a probability far below one in a thousand
BLOCK = 50_000  # vectors, or queries, of a list that one task holds
CALIBRATION = 400  # sampled queries that the number of probes is set by
SLACK = 1e-5  # of a squared distance, for rounding in single precision


@dataclass(frozen=True)
class Index:
    centroids: np.ndarray  # [list, column]
    rotation: np.ndarray
    sample: np.ndarray  # unit vectors
    probes: int

    def lists(self, unit: np.ndarray) -> np.ndarray:
        return (unit @ self.centroids.T).argmax(axis=1)


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    # Scaled by the largest component first, so that squares neither vanish nor overflow.
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def train(sample: np.ndarray, total: int, k: int, recall: float, seed: int = 5) -> Index:
    """Spherical k-means on the sample, and the probes that its own neighbours need."""
    rng = np.random.default_rng(seed)
    unit = unit_vectors(sample)
    rotation = np.linalg.qr(rng.standard_normal((unit.shape[1],) * 2))[0].astype(np.float32)
    count = int(min(max(1, round(total / LIST_SIZE)), MOST_LISTS, len(unit)))
    centroids = unit[rng.choice(len(unit), count, replace=False)].copy()
    for _ in range(ROUNDS):
        near = (unit @ centroids.T).argmax(axis=1)
        order = np.argsort(near, kind="stable")
        present, first = np.unique(near[order], return_index=True)
        sums = np.add.reduceat(unit[order].astype(np.float64), first, axis=0)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids[present] = np.where(length > 0, sums / np.where(length > 0, length, 1), centroids[present])
    asked = rng.choice(len(unit), min(CALIBRATION, len(unit)), replace=False)
    alike = unit[asked] @ unit.T
    alike[np.arange(len(asked)), asked] = -2
    nearest = np.argsort(-alike, axis=1)[:, :k]
    home = (unit @ centroids.T).argmax(axis=1)
    rank = np.argsort(np.argsort(-(unit[asked] @ centroids.T), axis=1), axis=1)
    needed = np.sort(rank[np.arange(len(asked))[:, None], home[nearest]].ravel()) + 1
    probes = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) if len(needed) else 1
    return Index(centroids, rotation, unit, min(count, probes))


def scan(
    query: np.ndarray, bound: float, blocks: list[np.ndarray], query_blocks: list[np.ndarray], k: int
) -> np.ndarray:
    """Candidates whose distance is among the ``k`` smallest, or as small but for rounding.

    ``blocks``: the rotated candidates' columns, block by block. ``bound``: a squared distance that ``k``
    vectors of the table are known to keep.
    """
    size, wide = len(blocks[0]), len(query)
    best = np.full(k, np.inf)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    # The first few are looked at alone, so that the list's own bound helps with the rest.
    for begin, end in ((0, min(4 * COLUMNS, size)), (min(4 * COLUMNS, size), size)):
        alive = np.arange(begin, end)
        partial = np.zeros(end - begin, np.float32)
        done = 0
        for block, part in zip(blocks, query_blocks):
            difference = block[alive] - part
            partial = partial + np.einsum("ij,ij->i", difference, difference)
            done += len(part)
            if done < wide:
                limit = min(bound, best[-1]) * (1 + ERROR / np.sqrt(done)) ** 2 * done / wide + SLACK
                keep = partial <= limit
                if not keep.all():
                    alive, partial = alive[keep], partial[keep]
        if len(alive):
            found.append((alive, partial))
            best = np.partition(np.concatenate([best, partial]), k - 1)[:k]
            best.sort()
    if not found:
        return np.zeros(0, np.int64)
    alive, distance = (np.concatenate(x) for x in zip(*found))
    return alive[distance <= min(bound, best[-1]) + SLACK]


def _matrix(column: pa.ChunkedArray | pa.Array, kind: type = np.float32) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(array), -1) if len(array) else flat.reshape(0, 1)


def _usable(vector: Column) -> Column:
    """Not NULL, not empty or zero, all components finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    queries: str,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    recall: float = 0.97,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: for each row that the condition ``queries`` selects its ``k`` nearest others.

    Nearness is the cosine of the original vectors in double precision; equal scores rank by the smaller key.
    Vectors that are NULL, zero or hold a NULL or non-finite component take no part, nor do rows without a key
    and vectors whose length is not the table's most frequent one (the smaller of two). Rows alike in key and
    vector count once; no row is an answer to its own key. With fewer candidates than ``k`` all are returned.
    Only key and vector are read besides what ``queries`` needs. An empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType.simpleString()
    empty = f"query_id {kind}, rank int, vec_id {kind}, score double"
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("v"), F.coalesce(F.expr(queries), F.lit(False)).alias("asked"))
    rows = rows.filter(F.col("id").isNotNull() & _usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], empty)
    rows = rows.filter(F.size("v") == sizes[0]["size"])

    # Equal vectors are one entry: its name is the smallest id.
    names = rows.groupBy("v").agg(F.min("id").alias("name"))
    ranked = rows.select("v", "id").distinct().withColumn("at", F.row_number().over(Window.partitionBy("v").orderBy("id")))
    entries = ranked.filter(F.col("at") <= k + 1).groupBy("v").agg(F.min("id").alias("name"), F.collect_list("id").alias("ids"))
    asking = rows.filter("asked").select("v", F.col("id").alias("query_id")).distinct().join(names, "v")

    total = names.count()
    sample = names.select("v").sample(min(1.0, 1.2 * SAMPLE / total), seed=3).limit(SAMPLE).collect()
    if not sample:
        sample = names.select("v").limit(SAMPLE).collect()
    model = train(np.array([r["v"] for r in sample], np.float64), total, k + 1, recall)
    index = spark.sparkContext.broadcast(plain(model))

    home_schema = T.StructType.fromDDL(f"name {kind}, list int, v array<double>, ids array<{kind}>")
    visit_schema = T.StructType.fromDDL(f"name {kind}, list int, v array<double>, bound float")
    home_arrow, visit_arrow = to_arrow_schema(home_schema), to_arrow_schema(visit_schema)

    def homes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = Index(*index.value).lists(unit_vectors(_matrix(batch.column(1), np.float64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(lists, pa.int32()), batch.column(1), batch.column(2)], schema=home_arrow
                )

    def visits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Index(*index.value)
        sample_homes = model.lists(model.sample)
        few = min(2 * k + 2, len(model.sample))
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                unit = unit_vectors(_matrix(batch.column(1), np.float64))
                near = np.argsort(-(unit @ model.centroids.T), axis=1, kind="stable")[:, : model.probes]
                alike = unit @ model.sample.T
                # The query's nearest vectors of the sample bound the distance, and their lists are probed as
                # well: so at least they are found. There are twice as many as are asked for.
                closest = np.argsort(-alike, axis=1)[:, :few]
                bound = np.full(len(unit), np.inf)
                if few == 2 * k + 2:
                    bound = 2 - 2 * np.take_along_axis(alike, closest[:, -1:], axis=1)[:, 0] + SLACK
                lists = [np.union1d(a, b) for a, b in zip(near, sample_homes[closest])]
                sizes = [len(x) for x in lists]
                who = pa.array(np.repeat(np.arange(len(unit)), sizes))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(who),
                        pa.array(np.concatenate(lists), pa.int32()),
                        batch.column(1).take(who),
                        pa.array(np.repeat(bound, sizes), pa.float32()),
                    ],
                    schema=visit_arrow,
                )

    as_double = F.col("v").cast("array<double>").alias("v")
    home = entries.select("name", as_double, "ids").mapInArrow(homes, home_schema)
    # A query whose vector many rows hold is asked once.
    visit = asking.select("name", as_double).distinct().mapInArrow(visits, visit_schema)

    def blocks_of(frame: DataFrame) -> Column:
        """How many blocks each list has; at most ``MOST_LISTS`` counts reach the driver."""
        counts = {r["list"]: -(-r["count"] // BLOCK) for r in frame.groupBy("list").count().collect()}
        large = [F.lit(x) for name, n in counts.items() if n > 1 for x in (name, n)]
        return F.coalesce(F.try_element_at(F.create_map(*large), F.col("list")), F.lit(1)) if large else F.lit(1)

    home_blocks, visit_blocks = blocks_of(home), blocks_of(visit)
    own = F.xxhash64("name")
    home = home.withColumn("block", F.pmod(own, home_blocks).cast("int"))
    home = home.withColumn("row", F.explode(F.sequence(F.lit(0), visit_blocks - 1)))
    visit = visit.withColumn("row", F.pmod(own, visit_blocks).cast("int"))
    visit = visit.withColumn("block", F.explode(F.sequence(F.lit(0), home_blocks - 1)))
    result = T.StructType.fromDDL(f"name {kind}, ids array<{kind}>, score double")
    result_arrow = to_arrow_schema(result)

    def search(here: pa.Table, asked: pa.Table) -> pa.Table:
        if not here.num_rows or not asked.num_rows:
            return result_arrow.empty_table()
        rotation = Index(*index.value).rotation
        original, wanted = _matrix(here.column("v"), np.float64), _matrix(asked.column("v"), np.float64)
        turned, turned_queries = unit_vectors(original) @ rotation, unit_vectors(wanted) @ rotation
        edges = range(0, turned.shape[1], COLUMNS)
        blocks = [np.ascontiguousarray(turned[:, e : e + COLUMNS]) for e in edges]
        lengths = np.linalg.norm(original, axis=1)
        bounds = asked.column("bound").to_numpy()
        left, right, scores = [], [], []
        for i, query in enumerate(turned_queries):
            near = scan(query, float(bounds[i]), blocks, [query[e : e + COLUMNS] for e in edges], k + 1)
            if len(near):
                score = original[near] @ wanted[i] / (lengths[near] * np.linalg.norm(wanted[i]))
                left.append(np.full(len(near), i))
                right.append(near)
                scores.append(score)
        if not left:
            return result_arrow.empty_table()
        ids = here.column("ids").combine_chunks().take(pa.array(np.concatenate(right)))
        names = asked.column("name").combine_chunks().take(pa.array(np.concatenate(left)))
        return pa.Table.from_arrays([names, ids, pa.array(np.concatenate(scores))], schema=result_arrow)

    place = ["list", "block", "row"]
    met = home.groupBy(*place).cogroup(visit.groupBy(*place)).applyInArrow(search, result)
    found = met.select("name", "score", F.explode("ids").alias("vec_id"))
    order = [F.desc("score"), F.asc("vec_id")]
    few = found.withColumn("at", F.row_number().over(Window.partitionBy("name").orderBy(*order))).filter(F.col("at") <= k + 1)
    answers = asking.select("query_id", "name").join(few.drop("at"), "name").filter("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return answers.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
