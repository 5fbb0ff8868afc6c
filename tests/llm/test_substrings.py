import random

import numpy as np
import pytest

from commentlens.llm import anchors, relative_parse, suffix_runs


def plain(rows, span, split=lambda t: (t or "").encode().split()):
    """(n, kept, number of removed runs) of each row, by looking up every window."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, out = {}, {}
    for i in order:
        items = split(rows[i][1])
        gone = [False] * len(items)
        for s in range(len(items) - span + 1):
            window = bytes(items[s : s + span]) if isinstance(items, bytes) else tuple(items[s : s + span])
            if window in seen:
                gone[s : s + span] = [True] * span
            else:
                seen[window] = i
        out[i] = (len(items), [x for x, g in zip(items, gone) if not g], sum(b and not a for a, b in zip([False, *gone], gone)))
    return out


def sample(rng, n_docs=60):
    passages = [[f"p{j}w{i}" for i in range(rng.choice([19, 20, 21, 45, 90]))] for j in range(8)]
    line = [f"line{i}" for i in range(8)]
    rows = []
    for i in range(n_docs):
        words = []
        for _ in range(rng.randrange(1, 9)):
            pick = rng.random()
            if pick < 0.4:
                p = rng.choice(passages)
                a = rng.randrange(len(p)) if rng.random() < 0.3 else 0
                words += p[a:]
            elif pick < 0.6:
                words += line
            elif pick < 0.7:
                words += ["x"] * rng.randrange(1, 60)
            else:
                words += [f"u{rng.random()}" for _ in range(rng.randrange(30))]
        rows.append((i, " ".join(words)))
    rows += [(n_docs, rows[3][1]), (n_docs + 1, rows[3][1]), (n_docs + 2, None), (n_docs + 3, ""), (n_docs + 4, " \n\t")]
    rows.append((n_docs + 5, "y z " * 3000))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,span,counts", [(4, 20, [50, 3, 0, 20, 200]), (1, 5, [9, 5]), (24, 100, [400, 99, 100])])
def test_anchors_cover_each_window_once(k, span, counts):
    rng = np.random.default_rng(0)
    values = rng.integers(0, 3, sum(counts)).astype(np.uint64)
    hashes = anchors.gram_hashes(values, k)
    assert len(hashes) == len(values) - k + 1
    for i, j in rng.integers(0, len(hashes), (200, 2)):
        assert (hashes[i] == hashes[j]) == bool((values[i : i + k] == values[j : j + k]).all())
    at, doc, low, high = anchors.anchors(hashes, np.array(counts), k, span)
    begins = np.cumsum(counts) - counts
    got = sorted((int(d), int(a - o)) for a, d, l, h in zip(at, doc, low, high) for o in range(l, h + 1))
    want = [(d, int(b) + s) for d, (b, n) in enumerate(zip(begins, counts)) for s in range(n - span + 1)]
    assert got == want
    assert all(0 <= l <= h <= span - k for l, h in zip(low, high))


@pytest.mark.parametrize("block", [1_000_000, 50])
def test_words_against_brute_force(make_docs, monkeypatch, block):
    monkeypatch.setattr(relative_parse, "BLOCK", block)
    monkeypatch.setattr(anchors, "BLOCK", block)
    rows = sample(random.Random(block))
    got = {r.key: r for r in relative_parse.remove_repeats(make_docs(rows, 4)).collect()}
    want = plain(rows, 20)
    texts = {d: (t or "").split() for d, t in rows}
    assert len(got) == len(rows)
    for i, (n, kept, _) in want.items():
        r = got[rows[i][0]]
        assert (r.n_words, r.n_removed, r.kept_text) == (n, n - len(kept), b" ".join(kept).decode())
        for f in r.factors:
            own = texts[r.key][f.start : f.start + f.length]
            assert len(own) == f.length >= 20 and own == texts[f.ref][f.ref_start : f.ref_start + f.length]
            assert (f.ref, f.ref_start) < (r.key, f.start)
    assert sum(r.n_removed for r in got.values()) > 1000


def test_repeated_keys_nulls_and_empty_of_words(make_docs):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(5, text), (5, text), (None, text), (None, text + " more"), (2, "a " + text)]
    got = [(r.key, r.n_words, r.n_removed) for r in relative_parse.remove_repeats(make_docs(rows)).collect()]
    assert sorted(got, key=repr) == [(2, 26, 0), (5, 25, 25), (5, 25, 25), (None, 25, 25), (None, 26, 25)]
    assert relative_parse.remove_repeats(make_docs([])).collect() == []


def test_loser_tree_merges_front_coded_runs():
    rng = np.random.default_rng(5)
    width = 12
    runs, everything = [], []
    for size in (40, 1, 0, 200, 7):
        rows = np.array(sorted(rng.integers(97, 99, (size, width)).astype(np.uint8).tolist()), np.uint8).reshape(-1, width)
        zero = np.zeros(size, np.int64)
        coded = suffix_runs.encode_run(rows, suffix_runs.prefixes(rows), zero, np.arange(size), zero, zero)
        assert size < 100 or len(coded) < size * (width + 16)  # front coding saves
        if size:
            runs.append(suffix_runs.Run(coded, width))
        everything += [r.tobytes() for r in rows]
    merged = list(suffix_runs.merge(runs, width))
    assert [m[0] for m in merged] == sorted(everything)
    for (a, *_), (b, shared, *_) in zip(merged, merged[1:]):
        same = next((i for i in range(width) if a[i] != b[i]), width)
        assert shared == same


@pytest.mark.parametrize("block,group", [(1_000_000, 300_000), (60, 300_000), (1_000_000, 5)])
def test_bytes_against_brute_force(make_docs, monkeypatch, block, group):
    for module in (anchors, suffix_runs):
        monkeypatch.setattr(module, "BLOCK", block)
    monkeypatch.setattr(suffix_runs, "GROUP", group)
    monkeypatch.setattr(suffix_runs, "CHUNK", 100)
    rows = sample(random.Random(7), 40)
    rows += [(900 + i, "\x00" * (90 + 5 * i) + "é" * 40 * i) for i in range(4)]
    got = {r.key: r for r in suffix_runs.remove_repeats(make_docs(rows, 4)).collect()}
    want = plain(rows, 100, lambda t: (t or "").encode())
    for i, (n, kept, runs) in want.items():
        r = got[rows[i][0]]
        assert (r.n_bytes, r.n_removed, bytes(r.kept)) == (n, n - len(kept), bytes(kept)), rows[i]
        assert len(r.spans) == runs and sum(s.length for s in r.spans) == r.n_removed
    assert len(got) == len(rows) and sum(r.n_removed for r in got.values()) > 5000


def test_repeated_keys_nulls_and_empty_of_bytes(make_docs):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text), (5, text), (None, text), (2, "a " + text[:120])]
    got = [(r.key, r.n_bytes, r.n_removed) for r in suffix_runs.remove_repeats(make_docs(rows)).collect()]
    n = len(text)
    assert sorted(got, key=repr) == sorted([(2, 122, 0), (5, n, 120), (5, n, n), (None, n, n)], key=repr)
    assert suffix_runs.remove_repeats(make_docs([])).collect() == []


@pytest.mark.parametrize("module", ["relative_parse", "suffix_runs"])
def test_offsets_beyond_a_byte_are_refused(make_docs, module):
    import importlib

    operator = importlib.import_module(f"commentlens.llm.{module}")
    with pytest.raises(ValueError, match="255"):
        operator.remove_repeats(make_docs([(1, "a b")]), span=300, gram=8)
