"""Near-dedup by the Jaccard similarity of word shingles: MinHash finds candidates, the whole sets of shingles decide.

A text's signature of minima is cut into bands of ``ROWS``; texts that share a band may be similar. One pass looks at every
band that several texts share. Its members stand in the order of the minima that follow the band, so that the most alike are
neighbours; each is compared with the band's smallest member and with the ``NEIGHBOURS`` before it, by a sketch of the
signature. Where the sketch says that a text is nearly the same as the smallest one, that pair alone is a candidate.
So this pass has at most a few times a band's members as candidates, whatever its size.
A band's members are dealt in blocks by their position, so a band that holds a third of all texts is many tasks.

Candidates are compared once, by all of their shingles (64-bit hashes). Components of the similar pairs give the
classes, of which the smallest row stays.

That leaves pairs with other texts between them. A second pass looks at each band whose members the links found so far do not make
one class, and meets every two of its members that are of different classes, block by block (``_across``), deciding there by their whole
sets: the comparisons grow with the square of such a band, the rows of any table do not, and a task holds two blocks.

What may be missed: by the formula a pair at similarity 0.8 shares no band with a chance of 3 in 100,000, at 0.9 of less than
1 in 10^9, and the sketch hides one with a chance below 1 in 100,000.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.llm.common import byte_texts, free_name, text_slices
from commentlens.llm.components import components
from commentlens.llm.ranking import ranked
from commentlens.session import written

BANDS = 20
ROWS = 4
NEIGHBOURS = 6
BLOCK = 512  # members of a band that are looked at together
HELD = 1 << 23  # bytes of their sets of shingles, at most
# Of the minima of a pair at 0.8 this share agrees but for a chance below 1 in 100,000; the second is near sameness.
LEAST_ALIKE, NEARLY_SAME = 0.6, 0.95
_RANDOM = np.random.default_rng(42).integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64)
_FACTORS, _ADDED = _RANDOM[0] * np.uint64(2) + np.uint64(1), _RANDOM[1]


def shingles(text: bytes, words: int) -> set[bytes]:
    """All runs of ``words`` lower-cased words; the whole of a shorter text; none without words."""
    found = text.lower().split()
    return {b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """The different shingles as sorted 64-bit hashes."""
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, 7) for s in shingles(text, words)], dtype=np.uint64))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays of different values."""
    if not len(a) or not len(b):
        return 0.0
    at = np.searchsorted(a, b)
    both = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return both / (len(a) + len(b) - both)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The minimum of each of the hash functions."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(hashes), 4096):
        np.minimum(least, (hashes[a : a + 4096, None] * _FACTORS + _ADDED).min(axis=0), out=least)
    return least


def bands(least: np.ndarray) -> list[int]:
    """One number per band, as a signed 64-bit integer."""
    digest = xxhash.xxh64_intdigest
    signed = [digest(bytes([i]) + row.tobytes(), 11) for i, row in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(signed, dtype=np.uint64).view(np.int64).tolist()


def _sketched(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Bands, and the sketch: 16 bits of each minimum."""
    for batch in text_slices(batches, 1):
        found: tuple[list, list] = ([], [])
        for text in byte_texts(batch, 1):
            hashes = shingle_hashes(text, words)
            least = signature(hashes)
            found[0].append(bands(least) if len(hashes) else [])
            found[1].append((least >> np.uint64(48)).astype(">u2").tobytes())
        columns = [batch.column(0), pa.array(found[0], pa.list_(pa.int64())), pa.array(found[1], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["own", "bands", "sketch"])


def _candidates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (band, block, position): the places of the pairs that may be similar."""
    now, before = None, []  # the members that stand before, with their sketches
    least, same = LEAST_ALIKE * BANDS * ROWS, NEARLY_SAME * BANDS * ROWS
    for batch in batches:
        names = ("band", "block", "context", "own", "sketch", "best", "best_sketch")
        band, block, context, own, sketch, best, best_sketch = (batch.column(batch.schema.get_field_index(n)) for n in names)
        sketches = [np.frombuffer(x, ">u2") for x in sketch.to_pylist()]
        firsts = [np.frombuffer(x, ">u2") for x in best_sketch.to_pylist()]
        mine, first = own.to_pylist(), best.to_pylist()
        out: tuple[list, list] = ([], [])
        for i, place in enumerate(zip(band.to_pylist(), block.to_pylist())):
            if place != now:
                now, before = place, []
            if not context[i].as_py():
                alike = int((sketches[i] == firsts[i]).sum()) if mine[i] != first[i] else 0
                met = [(first[i], alike)]
                if alike < same:
                    met += [(o, int((sketches[i] == s).sum())) for o, s in before]
                for other, n in met:
                    if n >= least and other != mine[i]:
                        a, b = sorted((mine[i], other), key=lambda x: (x["key"], x["text_hash"]))
                        out[0].append(b)
                        out[1].append(a)
            before = [*before[-NEIGHBOURS + 1 :], (mine[i], sketches[i])]
        yield pa.RecordBatch.from_arrays([pa.array(o, own.type) for o in out], names=["a", "b"])


def _across(batches: Iterable[pa.RecordBatch], exact: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by place (band and two blocks): links of a row of one block and a row of the other, of different classes.

    A pair counts as met at the smallest band that holds both. A link joins the two classes for the rest of the place, so a place
    has fewer links than rows.
    """
    alike_least = LEAST_ALIKE * BANDS * ROWS
    now, held, kind = None, [], None

    def met() -> pa.RecordBatch:
        ahead, after = ([x for x in held if x["block"] == now[side]] for side in (1, 2))
        sketches = np.array([np.frombuffer(x["sketch"], ">u2") for x in after]).reshape(len(after), -1)
        numbers = {r: i for i, r in enumerate({(x["root"]["key"], x["root"]["text_hash"]) for x in held})}
        first, classes = ([numbers[x["root"]["key"], x["root"]["text_hash"]] for x in rows] for rows in (ahead, after))
        joined, classes = np.arange(len(numbers)), np.array(classes, dtype=np.int64)
        sets: list[dict] = [{}, {}]  # the rows' shingles and bands as they were needed
        out: tuple[list, list] = ([], [])

        def of(side: int, i: int) -> tuple:
            if i not in sets[side]:
                row = (ahead, after)[side][i]
                sets[side][i] = (None if row["hashes"] is None else np.frombuffer(row["hashes"], np.uint64)), frozenset(row["bands"])
            return sets[side][i]

        for i, row in enumerate(ahead):
            start = i + 1 if now[1] == now[2] else 0
            alike = (sketches[start:] == np.frombuffer(row["sketch"], ">u2")).sum(axis=1)
            for j in (np.flatnonzero((alike >= alike_least) & (joined[classes[start:]] != joined[first[i]])) + start).tolist():
                (mine, in_bands), (other, also_in) = of(0, i), of(1, j)
                if joined[classes[j]] == joined[first[i]] or min(in_bands & also_in) != now[0]:
                    continue
                if mine is None or similarity(mine, other) >= exact:
                    a, b = sorted((row["own"], after[j]["own"]), key=lambda x: (x["key"], x["text_hash"]))
                    out[0].append(b)
                    out[1].append(a)
                    joined[joined == joined[classes[j]]] = joined[first[i]]
        return pa.RecordBatch.from_arrays([pa.array(o, kind) for o in out], names=["a", "b"])

    for batch in batches:
        kind = batch.column(batch.schema.get_field_index("own")).type
        for row in batch.to_pylist():
            row["block"] = row["kind"], row["number"]
            place = row["band"], (row["low_kind"], row["low"]), (row["high_kind"], row["high"])
            if place != now:
                if held:
                    yield met()
                now, held = place, []
            held.append(row)
    if held:
        yield met()


def across(placed: DataFrame, links: DataFrame, sets: Callable[[DataFrame], DataFrame] | None = None, least: float = 0.8) -> DataFrame | None:
    """Links ``a``, ``b`` of members of a band that ``links`` leave in different classes; None if there is no such band.

    ``placed``: own, band, position in it, members of it, and sketch. Bands of few members were met in full.
    ``sets`` gives ``own`` and ``hashes`` for rows of ``own``; without it the sketch alone decides. The decision falls where
    two blocks meet, so no table holds the pairs that are only looked at. Rows of a band are dealt by the size of their set: only
    neighbouring sizes can reach ``least``, and a block has so many rows that their sets are at most ``HELD`` bytes (or one row).
    """
    kind = placed.schema["own"].dataType.simpleString()
    classes = written(components(links, "a", "b"), "overlap")
    rows = placed.filter(F.col("members") > NEIGHBOURS + 1).join(classes.withColumnRenamed("node", "own"), "own", "left")
    rows = rows.withColumn("root", F.coalesce("root", "own"))
    split = rows.groupBy("band").agg(F.min("root").alias("one"), F.max("root").alias("other")).filter("one <> other").select("band")
    split = written(split, "overlap")
    if split.isEmpty():
        return None
    rows = rows.join(split, "band").select("band", "position", "own", "sketch", "root")
    involved = written(rows.groupBy("own").agg(F.collect_list("band").alias("bands")), "overlap")
    if sets is None:
        known = involved.withColumn("hashes", F.lit(None).cast("binary"))
    else:
        known = involved.join(sets(involved.select("own")), "own")
    known = written(known, "overlap")
    step = math.log(1 / least) + 1e-6
    size = F.greatest(F.coalesce(F.octet_length("hashes") / 8, F.lit(1)), F.lit(1))
    sized = known.select("own", F.floor(F.log(size) / step).alias("kind"))
    rows = ranked(rows.join(sized, "own"), ["band", "kind"], ["position", "own"], "place", "alike")
    room = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(HELD / 8 / F.exp((F.col("kind") + 1) * step))))
    rows = rows.withColumns({"number": F.floor(F.col("place") / room), "blocks": F.floor((F.col("alike") - 1) / room) + 1})
    counts = rows.select("band", "kind", "blocks").distinct()
    for name, by in (("above", 1), ("below", -1)):
        rows = rows.join(counts.select("band", (F.col("kind") - by).alias("kind"), F.col("blocks").alias(name)), ["band", "kind"], "left")

    def numbers(blocks: str):
        return F.when(F.col(blocks) > 0, F.sequence(F.lit(0).cast("bigint"), F.col(blocks) - 1)).otherwise(F.array().cast("array<bigint>"))

    def at(low_kind, low, high_kind, high):
        return F.struct(low_kind.alias("low_kind"), low.alias("low"), high_kind.alias("high_kind"), high.alias("high"))

    mine, number = F.col("kind"), F.col("number")
    places = F.concat(
        F.transform(numbers("blocks"), lambda o: at(mine, F.least(number, o), mine, F.greatest(number, o))),
        F.transform(numbers("above"), lambda o: at(mine, number, mine + 1, o)),
        F.transform(numbers("below"), lambda o: at(mine - 1, o, mine, number)),
    )
    rows = rows.join(known, "own").select("band", "kind", "number", "position", "own", "sketch", "root", "bands", "hashes", F.inline(places))
    place = ["band", "low_kind", "low", "high_kind", "high"]
    rows = rows.repartition(*place).sortWithinPartitions(*place, "kind", "number", "position")
    return rows.mapInArrow(lambda b: _across(b, least), f"a {kind}, b {kind}").distinct()


def _sets(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, 1):
        found = [shingle_hashes(t, words).tobytes() for t in byte_texts(batch, 1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["own", "hashes"])


def _similar(batches: Iterable[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        near = [similarity(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) >= least for a, b in sets]
        yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))


def similar_pairs(slim: DataFrame, words: int = 5, least: float = 0.8) -> DataFrame:
    """``a``, ``b``: links of rows given as ``own`` (a struct of key and text_hash) and ``text``, ``b`` smaller than ``a``.

    Similar rows are linked with each other or in steps, not each with all others.
    """
    kind = slim.schema["own"].dataType.simpleString()
    signed = written(slim.mapInArrow(lambda b: _sketched(b, words), f"own {kind}, bands array<long>, sketch binary"), "overlap")
    members = signed.select("own", F.posexplode("bands").alias("nth", "band"))
    shared = members.groupBy("band").agg(F.min("own").alias("best"), F.max("own").alias("last")).filter("best <> last")
    sharing = members.join(shared.select("band", "best"), "band").join(signed.select("own", "sketch"), "own")
    bests = signed.select(F.col("own").alias("best"), F.col("sketch").alias("best_sketch"))
    # The minima behind the band, in a circle.
    follow = F.expr(f"substring(concat(sketch, sketch), (nth + 1) * {2 * ROWS} + 1, {4 * ROWS})")
    rows = written(sharing.select("own", "band", "best", "sketch", follow.alias("follow")), "overlap")
    placed = ranked(rows, ["band"], ["follow", "own"], "position", "members")
    first = placed.join(bests, "best")
    block = F.floor(F.col("position") / BLOCK)
    own = F.struct(block.alias("block"), F.lit(False).alias("context"))
    ahead = F.when(F.col("position") % BLOCK >= BLOCK - NEIGHBOURS, F.struct((block + 1).alias("block"), F.lit(True).alias("context")))
    dealt = first.select("band", "position", "own", "sketch", "best", "best_sketch", F.explode(F.array(own, ahead)).alias("in"))
    dealt = dealt.filter("in IS NOT NULL").select("*", "in.*").drop("in").repartition("band", "block")
    dealt = dealt.sortWithinPartitions("band", "block", "position", "own")
    pairs = written(dealt.mapInArrow(_candidates, f"a {kind}, b {kind}").distinct(), "overlap")

    links = written(_verified(slim, pairs, words, least), "overlap")
    rest = across(placed, links, lambda own: _sets_of(slim, own, words), least)
    return links if rest is None else links.unionByName(rest)


def _sets_of(slim: DataFrame, own: DataFrame, words: int) -> DataFrame:
    kind = slim.schema["own"].dataType.simpleString()
    texts = slim.join(own, "own", "left_semi").select("own", "text")
    # Rows alike in key and text hash are one row here.
    return texts.mapInArrow(lambda b: _sets(b, words), f"own {kind}, hashes binary").groupBy("own").agg(F.first("hashes").alias("hashes"))


def _verified(slim: DataFrame, pairs: DataFrame, words: int, least: float) -> DataFrame:
    """Those of the pairs whose whole sets of shingles are similar."""
    kind = slim.schema["own"].dataType.simpleString()
    involved = pairs.select(F.explode(F.array("a", "b")).alias("own")).distinct()
    sets = slim.join(involved, "own", "left_semi").select("own", "text").mapInArrow(lambda b: _sets(b, words), f"own {kind}, hashes binary")
    sets = written(sets, "overlap")
    left = sets.select(F.col("own").alias("a"), F.col("hashes").alias("of_a"))
    right = sets.select(F.col("own").alias("b"), F.col("hashes").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")
    return both.mapInArrow(lambda b: _similar(b, least), f"a {kind}, b {kind}")


def drop_similar(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, least: float = 0.8) -> DataFrame:
    """Rows without those that links of a Jaccard similarity of ``least`` connect, in any number of steps, to a smaller row.

    So one row of each class stays, the one with the smallest key; of rows with one key the one with the smaller text hash
    counts as smaller. Texts without words are similar to none. Rows alike in both, and rows whose key is NULL, stay. Texts may be
    of any length. Only key and text are read, and columns of any name are kept. An empty table gives an empty result.
    """
    body = F.col(text).cast("string")
    own = F.struct(F.col(key).alias("key"), F.xxhash64(body).alias("text_hash")).alias("own")
    slim = docs.filter(F.col(key).isNotNull()).select(own, body.alias("text"))
    classes = components(similar_pairs(slim, words, least), "a", "b")
    name_key, name_hash = (free_name(n, docs.columns) for n in ("key_of", "hash_of"))
    gone = classes.filter("node <> root").select(F.col("node.key").alias(name_key), F.col("node.text_hash").alias(name_hash))
    return docs.join(gone, (F.col(key) == F.col(name_key)) & (F.xxhash64(body) == F.col(name_hash)), "left_anti")
