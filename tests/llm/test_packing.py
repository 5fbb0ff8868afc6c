import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from commentlens.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def check(rows, texts, tokenizer, window=packing.WINDOW):
    """Every id in exactly one piece, sequences gapless and within the window, digests right."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert by_doc.keys() == texts.keys()
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window


def test_small_cases(make_docs, tokenizer):
    texts = {
        1: "Hello there, l'été d'août!\n İx é <|endoftext|> tail",
        2: None,
        3: "",
        4: " \t\n ",
        5: "word " * 9000,
        6: "a<|startoftext|>b 12345 \x1c\x1d z",
        7: "Σίσυφος ΟΔΥΣΣΕΥΣ ǅ ﬁ",
    }
    rows = packing.pack(make_docs(texts.items()), FILE).collect()
    check(rows, texts, tokenizer)


def test_many_partitions_leave_little_padding(make_docs, tokenizer):
    texts = {i: f"text {i} " + "some words, here " * (i * 37 % 300) for i in range(600)}
    pieces = packing.pack(make_docs(texts.items(), partitions=12), FILE, window=256, open_windows=4)
    check(pieces.collect(), texts, tokenizer, 256)
    total = packing.padding(pieces, 256).first()
    assert total["padding"] < 0.05 * total["tokens"]


def test_repeated_rows_and_empty_table(make_docs):
    rows = packing.pack(make_docs([(1, "same text"), (1, "same text"), (None, "same text")]), FILE).collect()
    assert sorted((r.doc_id is None, r.length) for r in rows) == [(False, 3), (False, 3), (True, 3)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3
    assert packing.pack(make_docs([]), FILE).collect() == []


def test_windows_prefer_the_best_fit():
    out = []
    windows = packing.OpenWindows(100, 2, lambda pieces: out.append([p[0] for p in pieces]))
    for doc, n in enumerate([60, 70, 25, 35, 90]):
        windows.place(doc, 0, n)
    # 25 fits both and goes where it leaves less; 35 fills the other up to 95; 90 meets gaps too small to cut.
    assert out == [[0, 3]]
    assert [[p[0] for p in pieces] for _, pieces in windows.open] == [[1, 2], [4]]
