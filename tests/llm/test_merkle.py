"""The manifest against a plain recursive one."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from commentlens.llm import merkle
from commentlens.llm.ranking import ranked


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def plain_tree(leaves, arity=3):
    """Root, and of each leaf the siblings from the bottom up."""
    proofs, at = [[] for _ in leaves], list(range(len(leaves)))
    nodes = leaves
    while len(nodes) > 1:
        for i, place in enumerate(at):
            first = place // arity * arity
            proofs[i] += [n for j, n in enumerate(nodes[first : first + arity], first) if j != place]
            at[i] = place // arity
        nodes = [h(nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
    return nodes[0], proofs


def plain_manifest(rows):
    """(doc_id, text, source): leaf, subroot, root and proof of each row, in order of source and id."""
    groups = {}
    for r in sorted(rows, key=lambda r: (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, plain_leaf(r))):
        groups.setdefault(r[2], []).append(plain_leaf(r))
    trees = {g: plain_tree(leaves) for g, leaves in groups.items()}
    root, over = plain_tree([t[0] for t in trees.values()])
    return sorted(
        (leaf, trees[g][0], root, h([*proof, *above]))
        for (g, leaves), above in zip(groups.items(), over) for leaf, proof in zip(leaves, trees[g][1])
    )


def made(docs, levels):
    return merkle.build(docs, columns=("doc_id", "text", "source"), block_levels=levels)


def digests(found):
    return sorted((r.leaf.hex(), r.subroot.hex(), r.root, r.proof_sha256) for r in found.collect())


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_against_plain(make_docs, levels):
    rng = random.Random(levels)
    sizes = {"hot": 101, "b": 27, "ä": 28, "": 9, None: 4, "one": 1, "two": 2, "z": 3}
    keys = iter(rng.sample(range(-500, 1000), sum(sizes.values())))
    rows = [(next(keys), rng.choice([None, "", "x\ny", "long " * 2000, "t"]), s) for s, n in sizes.items() for _ in range(n)]
    rows += [(None, "no key", "b"), (None, "another", "b"), (rows[0][0], "same key", "hot")] + [(7000, "alike", "z")] * 5
    rng.shuffle(rows)
    found = merkle.verify(made(make_docs(rows, 5), levels))
    assert digests(found) == plain_manifest(rows)
    assert found.filter("NOT verified").isEmpty()


def test_tampering_is_seen(make_docs):
    rows = [(i, f"text {i}", f"s{i % 3}") for i in range(40)]
    manifest = made(make_docs(rows), 1)
    changed = manifest.rows.withColumn("given", F.when(F.col("doc_id") % 5 == 0, F.unhex(F.sha2("leaf", 256))).otherwise(F.col("leaf")))
    for r in merkle.verify(merkle.Manifest(changed, manifest.root), "given").collect():
        assert r.verified == (r.doc_id % 5 != 0) and (r.folded_root == r.root) == r.verified


def test_appends_extend_witnesses():
    runs = merkle.OpenRuns(3)
    leaves = [bytes([i]) * 32 for i in range(10)]
    for leaf in leaves[:3]:
        runs.append(leaf)
    assert [len(w) for w in runs.witness] == [1, 1, 1]  # their run is complete, the one above is open
    for leaf in leaves[3:]:
        runs.append(leaf)
    assert [len(w) for w in runs.witness] == [2] * 9 + [0]
    root = runs.close()
    assert all(merkle.fold(leaf, b"".join(w)) == root for leaf, w in zip(leaves, runs.witness))
    assert root.hex() == plain_tree([x.hex() for x in leaves])[0]


def test_empty_one_row_and_clashing_columns(spark, make_docs):
    nothing = made(make_docs([]), 5)
    assert nothing.root is None and merkle.verify(nothing).collect() == []
    (row,) = merkle.verify(made(make_docs([(1, None)]), 5)).collect()
    assert row.leaf.hex() == row.subroot.hex() == row.root and row.proof_sha256 == hashlib.sha256(b"").hexdigest()
    names = ["group", "position", "size", "digest", "carried", "witness", "top", "leaf", "root", "rest", "block", "index"]
    rows = [(i, f"t{i}", "s") for i in range(12)]
    wide = make_docs(rows).select("*", *[F.lit(n).alias(n) for n in names])
    assert digests(merkle.verify(made(wide, 1))) == plain_manifest(rows)
    with pytest.raises(ValueError):
        merkle.build(wide, arity=16)


def test_ranked(spark):
    rows = [(g, v) for g, n in (("a", 200), (None, 7), ("b", 1)) for v in range(n)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows + [("a", 5)] * 3, "g string, v int").repartition(6)
    got = sorted(((r.g or "", r.v, r.at, r.n) for r in ranked(df, ["g"], ["v"], "at", "n").collect()), key=lambda r: (r[0], r[2]))
    want = []
    for g in ("", "a", "b"):
        values = sorted(r[1] for r in rows + [("a", 5)] * 3 if (r[0] or "") == g)
        want += [(g, v, i, len(values)) for i, v in enumerate(values)]
    assert got == want
