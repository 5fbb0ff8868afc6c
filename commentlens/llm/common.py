"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import dataclasses
import sys
import types
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a NULL key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def free_name(wanted: str, taken: Iterable[str]) -> str:
    """``wanted``, lengthened until no column of the caller has that name (names ignore case)."""
    used = {c.lower() for c in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def text_slices(
    batches: Iterable[pa.RecordBatch], column: int, most: int = 4_000_000, rows: int = 2_000
) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes of text; one longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if i > start and (total + size > most or i - start >= rows):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        yield batch.slice(start, batch.num_rows - start)


def _views(array: pa.Array) -> list[bytes | None]:
    return array.cast(pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()).to_pylist()


def byte_texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    """The texts of a column as UTF-8 bytes; NULL is empty."""
    return [x or b"" for x in _views(batch.column(column))]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(start, start + length)``."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def plain(value: object) -> tuple:
    """A dataclass as a tuple of its fields. A broadcast refers to classes by name, and an executor need not
    hold this package; so values are sent as tuples and the class, which travels with the function, is filled again."""
    return tuple(getattr(value, f.name) for f in dataclasses.fields(value))


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, so that its next tasks find it again.

    Functions of this package travel by value and bring fresh globals with each task.
    """
    module = sys.modules.setdefault(f"_worker_store_{name}", types.ModuleType(name))
    return module.__dict__.setdefault("store", {})


def leave_stores() -> None:
    """Empties what other operators' tasks keep in this Python worker, which the session goes on using."""
    for name, module in list(sys.modules.items()):
        if name.startswith("_worker_store_"):
            module.__dict__.get("store", {}).clear()
    pa.default_memory_pool().release_unused()
