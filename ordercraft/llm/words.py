"""Words of whole texts as 64-bit hashes, many texts at a time (numpy), and fixed-size counting of them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ordercraft import session

# Rows and bytes of one Arrow batch between Spark and Python in this package's steps: whole texts are long, some very long.
# Spark and the Python worker each hold a batch outside the heap, and keep most of that memory for later batches.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20
_BATCH, _BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark):
    """The session's Arrow batches are at most ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes (but for a longer row) while a step runs."""
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    before = {_BATCH: spark.conf.get(_BATCH), _BYTES: spark.conf.get(_BYTES)}
    rows, held = int(before[_BATCH]), size(before[_BYTES])
    try:
        spark.conf.set(_BATCH, str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS))
        spark.conf.set(_BYTES, str(min(held, BATCH_BYTES) if held > 0 else BATCH_BYTES))
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``session.materialize`` with small Arrow batches."""
    with small_batches(df.sparkSession):
        return session.materialize(df, label)


# A word byte keeps its value (A-Z become a-z); any other byte becomes 0. In UTF-8 all bytes of characters from
# U+0080 up are word bytes, so words are runs of 0-9, a-z and characters from U+0080 up.
_FOLD = np.zeros(256, np.uint8)
for _b in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _FOLD[_b] = _b
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BASE = 0x9E3779B97F4A7C15
SLICE_BYTES = 256 << 10  # stays in the processor cache


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of uint64 values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    p = np.full(max(n, 1), base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of consecutive items of about ``limit`` bytes in all; a longer item stands alone."""
    i = total = 0
    for j, size in enumerate(sizes):
        if total and total + size > limit:
            yield i, j
            i, total = j, 0
        total += size
    if i < len(sizes):
        yield i, len(sizes)


_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = powers(2 * SLICE_BYTES), powers(2 * SLICE_BYTES, _INVERSE)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (uint64) and the index of its text, in order."""
    raw = _FOLD[np.frombuffer(b"\0" + b"\0".join(texts) + b"\0", np.uint8)]
    inside = raw != 0
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if not len(edges):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    before, last = edges[::2], edges[1::2]  # of each word: the byte in front of it, and its last byte
    n = len(raw)
    up, down = _POWERS if n <= len(_POWERS[0]) else (powers(n), powers(n, _INVERSE))
    sums = np.multiply(raw, up[:n])  # a word's polynomial is a difference of running sums, taken back to its first byte
    np.cumsum(sums, out=sums)
    hashes = mix64((sums[last] - sums[before]) * down[before + 1])
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(before, ends), prepend=0))


def count_words(texts: list[bytes]) -> np.ndarray:
    """Number of words of each text."""
    raw = np.frombuffer(b"\0" + b"\0".join(texts) + b"\0", np.uint8)
    inside = _FOLD[raw] != 0
    starts = np.cumsum(inside[1:] & ~inside[:-1])
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    return np.diff(starts[ends], prepend=0)


@F.pandas_udf(T.LongType())
def word_count(texts: pd.Series) -> pd.Series:
    """Number of words of a text, 0 for NULL. (A pattern of the regular-expression engine takes several times as long.)"""
    raw = [t.encode() if t is not None else b"" for t in texts]
    return pd.Series(np.concatenate([count_words(raw[i:j]) for i, j in slices([len(t) for t in raw])]) if raw else [], dtype="int64")


def gram_hashes(words: np.ndarray, n: int, base: int = _BASE) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words (may cross texts: see ``whole``)."""
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for j, p in enumerate(powers(n, base)):
        out += words[j:len(words) - n + 1 + j] * p
    return mix64(out)


def whole(owner: np.ndarray, n: int) -> np.ndarray:
    """Which runs of ``n`` words lie in one text."""
    return owner[:len(owner) - n + 1] == owner[n - 1:] if len(owner) >= n else np.zeros(0, bool)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def count_cells(rows: DataFrame, cells_of, bits: int) -> np.ndarray:
    """How often each of ``2**bits`` hash cells occurs, over all rows of ``rows``: a table of fixed size (uint32).

    ``cells_of(batch)`` gives arrays of cells of an Arrow batch. Every task adds up its own counts and passes on the cells
    that it met, by chunks; the tasks' counts are added per chunk.
    """
    width = min(bits, 12)

    def count(batches):
        total = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for cells in cells_of(batch):
                np.add.at(total, cells, 1)
        met = np.flatnonzero(total)
        if not len(met):
            return
        cuts = np.flatnonzero(np.diff(met >> width, prepend=-1))
        parts = list(zip(cuts, np.append(cuts[1:], len(met)), strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(met[cuts] >> width, pa.int32()),
             pa.array([(met[i:j] & ((1 << width) - 1)).astype(np.uint16).tobytes() for i, j in parts], pa.binary()),
             pa.array([total[met[i:j]].tobytes() for i, j in parts], pa.binary())], names=["chunk", "cells", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, cells, counts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "cells", "counts")), strict=True):
                total = sums.setdefault(at, np.zeros(1 << width, np.uint32))
                total[np.frombuffer(cells, np.uint16)] += np.frombuffer(counts, np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([c.tobytes() for c in sums.values()], pa.binary())],
            names=["chunk", "counts"])

    parts = rows.mapInArrow(count, "chunk int, cells binary, counts binary")
    table = np.zeros((1 << (bits - width), 1 << width), np.uint32)
    with small_batches(rows.sparkSession):
        for row in parts.repartition("chunk").mapInArrow(add, "chunk int, counts binary").toLocalIterator():
            table[row["chunk"]] = np.frombuffer(row["counts"], np.uint32)
    return table.reshape(-1)


def mark_cells(rows: DataFrame, cells_of, bits: int) -> np.ndarray:
    """Which of ``2**bits`` hash cells occur, as packed bits: a filter of fixed size (see ``marked``)."""
    width = 12  # bytes of a chunk, as a power of two

    def mark(batches):
        some = np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            cells = cells_of(batch)
            np.bitwise_or.at(some, cells >> 3, (1 << (cells & 7)).astype(np.uint8))
        chunks = some.reshape(-1, 1 << width)
        met = np.flatnonzero(chunks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array([chunks[m].tobytes() for m in met], pa.binary())], names=["chunk", "bits"])

    def join(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, raw in zip(batch.column("chunk").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                sums[at] = np.frombuffer(raw, np.uint8) | sums.get(at, np.uint8(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([c.tobytes() for c in sums.values()], pa.binary())], names=["chunk", "bits"])

    out = np.zeros((1 << (bits - 3 - width), 1 << width), np.uint8)
    with small_batches(rows.sparkSession):
        for row in rows.mapInArrow(mark, "chunk int, bits binary").repartition("chunk").mapInArrow(
                join, "chunk int, bits binary").toLocalIterator():
            out[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def marked(some: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Which cells a filter of ``mark_cells`` holds."""
    return ((some[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1).astype(bool)


def maybe_in(wanted: DataFrame, column: str, bits: int = 26):
    """A function of a column: whether its value may be among ``wanted``'s, by a filter of fixed size (never wrongly no).

    Rows that it rules out need not be shuffled to a join with ``wanted``.
    """
    def cell(values) -> np.ndarray:
        return (np.asarray(values, np.int64).view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)

    some = wanted.sparkSession.sparkContext.broadcast(mark_cells(
        wanted.select(F.xxhash64(column).alias("cell")), lambda batch: cell(batch.column("cell").to_numpy()), bits))

    @F.pandas_udf(T.BooleanType())
    def test(values: pd.Series) -> pd.Series:
        return pd.Series(marked(some.value, cell(values)))

    return lambda name: test(F.xxhash64(name))


def without(rows: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    """``rows`` whose ``column`` is not a value of the one-column table ``gone`` (a written table; NULL equals NULL).

    Only rows that a filter of fixed size cannot clear are shuffled.
    """
    name = gone.columns[0]
    test, other = maybe_in(gone, name), free(rows, "_gone")
    gone = gone.withColumnRenamed(name, other)
    rest = rows.where(test(column)).join(gone, F.col(column).eqNullSafe(F.col(other)), "left_anti")
    return rows.where(~test(column)).unionByName(rest)


def free(df: DataFrame, name: str) -> str:
    """``name``, or the like, as a column that ``df`` does not have."""
    while name in df.columns:
        name = "_" + name
    return name


def text_key(text="text"):
    """128-bit key of a text's content (NULL for NULL): equal texts are worked on once."""
    return F.unhex(F.md5(F.col(text).cast("binary")))
