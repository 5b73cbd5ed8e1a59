"""Repeated byte strings within and across documents.

Every byte covered by a 200-byte string that starts at two places goes. As in a difference-cover suffix sort, only
sampled positions are named and compared across the corpus, names are refined level by level, and the remaining
positions get their place from the sample next to them. Two things differ from the textbook form, so that the work can
be dealt out by key and nothing is sorted byte by byte: the sample is chosen by content (of every stretch of 85 grams
the smallest), so equal strings have equal samples at equal offsets and need no comparison by residue; and names are
128-bit fingerprints of the text that they cover, as only equality of 200-byte prefixes is asked for, not their order.

1. A window is a 200-byte string. Its sample is the smallest gram of its middle 100 bytes; 50 bytes before and 66 from
   it always lie in the window. Samples whose 116-byte surroundings occur once are dropped: no window of theirs repeats.
2. Consecutive windows with one sample form a block. Blocks that occur twice as a whole are repeated.
3. Where equal surroundings lie in different blocks, the bytes of one copy of each block are brought together, and their
   single windows are named and compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ordercraft.llm.words import mark_cells, marked, materialize, mix64, powers, text_bytes, text_key

LENGTH = 200
MARGIN = 50  # a window's middle starts here
GRAM = 16
STRETCH = 85  # grams of the middle 100 bytes
AROUND = MARGIN + GRAM  # bytes from the sample that always lie in the window
FILTER_BITS = 26
HELD = 4096  # copies of blocks that are compared at a time, unless one group has more
CROWD = 20_000  # copies of one group that are compared in one task; larger groups are dealt out by window
PIECE = 4 << 20  # longer texts are cut into overlapping pieces
SLICE = 256 << 10
SEEN = 1_000_000
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POSITION = np.uint64((1 << 24) - 1)


class Slice:
    """Windows, samples and fingerprints of the texts (of 200 bytes or more) laid end to end in one buffer."""

    def __init__(self, pieces: list[tuple[int, int, bytes]]):
        data = b"".join(p[2] for p in pieces) + bytes(GRAM + 8)
        n = len(data) - GRAM - 8
        sizes = np.array([len(p[2]) for p in pieces])
        self.first = np.cumsum(sizes) - sizes  # where each piece starts
        self.owner = np.array([p[0] for p in pieces])
        self.base = np.array([p[1] for p in pieces]) - self.first  # buffer position + base = position in the text
        raw = np.frombuffer(data, np.uint8)
        words = np.lib.stride_tricks.as_strided(raw[:8].view(np.uint64), (n + 9,), (1,))
        self._mixed = mix64(words[:n + 1].copy())
        grams = self._mixed[:n] * np.uint64(_BASES[1]) + mix64(words[8:n + 8].copy())
        low = (mix64(grams) & ~_POSITION) | np.arange(n, dtype=np.uint64)
        span = 1
        while span * 2 <= STRETCH:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        low = np.minimum(low[:len(low) - (STRETCH - span)], low[STRETCH - span:])
        # windows that end in their own piece, and the sample of each
        start = np.arange(n - LENGTH + 1)
        self.piece = np.repeat(np.arange(len(pieces)), sizes)[:len(start)]
        start = start[start + LENGTH <= (self.first + sizes)[self.piece]]
        self.start, self.window_piece = start, self.piece[start]
        self.piece = self.window_piece
        sample = (low[start + MARGIN] & _POSITION).astype(np.int64)
        cut = np.flatnonzero(np.r_[True, (sample[1:] != sample[:-1]) | (start[1:] != start[:-1] + 1)])
        self.low, self.high = start[cut], start[np.append(cut[1:], len(start)) - 1]
        self.sample, self.piece = sample[cut], self.piece[cut]
        self._sums = []
        for base in _BASES:
            self._sums.append((np.r_[np.zeros(1, np.uint64), np.cumsum(self._mixed[:n] * powers(n, base))], powers(n + 1, pow(base, -1, 1 << 64))))

    def name(self, at: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        """Fingerprint of the bytes [at, end)."""
        sums, inverse = self._sums[which]
        return mix64((sums[end - 7] - sums[at]) * inverse[at] + (end - at).astype(np.uint64)).view(np.int64)

    def block_names(self, which: np.ndarray) -> np.ndarray:
        """Fingerprint of a block's bytes and of the sample's place in it."""
        low = self.low[which]
        offset = mix64((self.sample[which] - low).astype(np.uint64))
        return (offset ^ self.name(low, self.high[which] + LENGTH, 1).view(np.uint64)).view(np.int64)

    def around(self) -> np.ndarray:
        """Fingerprint of the surroundings of each block's sample."""
        return self.name(self.sample - MARGIN, self.sample + AROUND, 0)


def _slices(texts: list[bytes], use: Iterator[int]) -> Iterator[Slice]:
    held, size = [], 0
    for n in use:
        text = texts[n]
        for at in range(0, max(len(text) - LENGTH + 1, 0), PIECE):
            piece = text[at:at + PIECE + LENGTH - 1]
            if held and size + len(piece) > SLICE:
                yield Slice(held)
                held, size = [], 0
            held.append((n, at, piece))
            size += len(piece)
    if held:
        yield Slice(held)


def _new(keys: list[bytes], seen: set[bytes]) -> Iterator[int]:
    """Rows whose text this task has not worked on (it may forget, which only repeats work)."""
    for n, key in enumerate(keys):
        if key not in seen:
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(key)
            yield n


def _cell(fingerprint: np.ndarray) -> np.ndarray:
    return (fingerprint.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _filter(rows: DataFrame, column: str):
    """Filter of fixed size on a column of 64-bit fingerprints, sent to all tasks."""
    def cells(batch: pa.RecordBatch) -> np.ndarray:
        return _cell(batch.column(column).to_numpy())

    return rows.sparkSession.sparkContext.broadcast(mark_cells(rows.select(column), cells, FILTER_BITS))


def _samples(texts: DataFrame) -> DataFrame:
    def samples(batches):
        seen: set[bytes] = set()
        for batch in batches:
            keys = batch.column("key").to_pylist()
            for s in _slices(text_bytes(batch), _new(keys, seen)):
                place = _places(keys, s.owner[s.piece], s.sample + s.base[s.piece])
                yield pa.RecordBatch.from_arrays([pa.array(s.around()), pa.array(place)], names=["around", "place"])

    return texts.mapInArrow(samples, "around long, place long")


def _places(keys: list[bytes], owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One integer per place (text and position)."""
    text = np.array([int.from_bytes(k[:8], "little") for k in keys], np.uint64)
    return mix64(text[owner] + at.astype(np.uint64) * np.uint64(_BASES[0])).view(np.int64)


def _blocks(texts: DataFrame, some) -> DataFrame:
    def blocks(batches):
        seen: set[bytes] = set()
        for batch in batches:
            keys = batch.column("key").to_pylist()
            for s in _slices(text_bytes(batch), _new(keys, seen)):
                around = s.around()
                hit = np.flatnonzero(marked(some.value, _cell(around)))
                low, high, owner, base = s.low[hit], s.high[hit], s.owner[s.piece[hit]], s.base[s.piece[hit]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(owner)), pa.array(around[hit]), pa.array(s.block_names(hit)),
                     pa.array(_places(keys, owner, low + base)), pa.array(low + base), pa.array(high + base)],
                    names=["key", "around", "name", "place", "low", "high"])

    return texts.mapInArrow(blocks, "key binary, around long, name long, place long, low long, high long")


def _copies(texts: DataFrame, some) -> DataFrame:
    """The bytes of the blocks whose place is in the filter."""
    def copies(batches):
        seen: set[bytes] = set()
        for batch in batches:
            keys, raw = batch.column("key").to_pylist(), text_bytes(batch)
            for s in _slices(raw, _new(keys, seen)):
                owner, base = s.owner[s.piece], s.base[s.piece]
                low, high = s.low + base, s.high + base
                hit = np.flatnonzero(marked(some.value, _cell(_places(keys, owner, low))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(owner[hit])), pa.array(s.around()[hit]), pa.array(low[hit]),
                     pa.array([raw[owner[n]][low[n]:high[n] + LENGTH] for n in hit], pa.binary())],
                    names=["key", "around", "low", "bytes"])

    return texts.mapInArrow(copies, "key binary, around long, low long, bytes binary")


def _matched(copies: DataFrame) -> DataFrame:
    """``key, low, end``: runs of windows of ``copies(key, around, low, bytes)`` that two copies with equal surroundings share.

    Rows come sorted by their surroundings; a task names and compares the windows of some groups at a time.
    """
    def match(rows: list[tuple[bytes, int, int, bytes]]) -> pa.RecordBatch:
        s = Slice([(n, r[2], r[3]) for n, r in enumerate(rows)])
        start, piece = s.start, s.window_piece
        w1, w2 = s.name(start, start + LENGTH, 0), s.name(start, start + LENGTH, 1)
        order = np.lexsort((w2, w1))
        same = (w1[order][1:] == w1[order][:-1]) & (w2[order][1:] == w2[order][:-1])
        again = np.zeros(len(start), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        start, piece = start[again], piece[again]
        cut = np.flatnonzero(np.r_[True, (np.diff(piece) != 0) | (np.diff(start) != 1)]) if len(start) else start
        last = np.append(cut[1:], len(start)) - 1 if len(start) else cut
        base = s.base[piece]
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[n][0] for n in piece[cut]], pa.binary()), pa.array((start + base)[cut]),
             pa.array((start + base)[last] + LENGTH)], names=["key", "low", "end"])

    def groups(batches):
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "around", "low", "bytes")), strict=True):
                if held and row[:3] == held[-1][:3]:
                    continue  # the same place, from another task
                if len(held) >= HELD and row[1] != held[-1][1]:
                    yield match([(r[0], r[1], r[2], r[3]) for r in held])
                    held = []
                held.append(row)
        if held:
            yield match(held)

    ordered = copies.repartition("around").sortWithinPartitions("around", "key", "low")
    return ordered.mapInArrow(groups, "key binary, low long, end long")


def _crowded(copies: DataFrame) -> DataFrame:
    """As ``_matched``, for groups too large for one task: every window is a row and goes where its name says."""
    def windows(batches):
        for batch in batches:
            rows = batch.num_rows
            for i in range(0, rows, HELD):
                part = batch.slice(i, HELD)
                raw = part.column("bytes").to_pylist()
                s = Slice([(n, at, b) for n, (at, b) in enumerate(zip(part.column("low").to_pylist(), raw, strict=True))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(s.window_piece)), pa.array(s.start + s.base[s.window_piece]),
                     pa.array(s.name(s.start, s.start + LENGTH, 0)), pa.array(s.name(s.start, s.start + LENGTH, 1))],
                    names=["key", "low", "w1", "w2"])

    rows = materialize(copies.select("key", "low", "bytes").mapInArrow(windows, "key binary, low long, w1 long, w2 long"), "repeats-windows")
    rows = rows.withColumn("place", F.xxhash64("key", "low"))
    again = rows.groupBy("w1", "w2").agg(_repeated(F.col("place")).alias("again")).where("again").select("w1", "w2")
    return rows.join(again, ["w1", "w2"], "left_semi").select("key", "low", (F.col("low") + LENGTH).alias("end"))


def _repeated(place: Column) -> Column:
    """Whether rows with more than one place were grouped: partial sums, however many there are."""
    return F.min(place) != F.max(place)


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """``key, ranges``: per distinct text with repeats, byte ranges (low, end) that together are all repeated bytes.

    Strings in copies of one text do not count here: a text of 200 bytes or more with copies is repeated as a whole.
    """
    texts = docs.where(F.octet_length("text") >= LENGTH).select(text_key().alias("key"), "text")
    around = _samples(texts).groupBy("around").agg(_repeated(F.col("place")).alias("again")).where("again").select("around")
    some = _filter(materialize(around, "repeats-samples"), "around")
    blocks = materialize(_blocks(texts, some), "repeats-blocks")
    name = ["around", "name"]
    place = F.col("place")
    named = materialize(blocks.groupBy(*name).agg(F.min(place).alias("place"), _repeated(place).alias("again")), "repeats-names")
    whole = blocks.join(named.where("again").select(*name), name, "left_semi").select("key", "low", (F.col("high") + LENGTH).alias("end"))

    # surroundings with several blocks, one of them not repeated as a whole: one copy of each block
    mixed = named.groupBy("around").agg(F.count("*").alias("n"), F.min("again").alias("all")).where("n > 1 and not all")
    mixed = materialize(mixed.select("around", (F.col("n") > CROWD).alias("crowd")), "repeats-mixed")
    chosen = materialize(named.join(mixed, "around", "left_semi").select("place"), "repeats-chosen")
    copies = _copies(texts, _filter(chosen, "place"))  # others that pass the filter only add work
    crowds = mixed.where("crowd").select("around")
    if crowds.isEmpty():
        single = _matched(copies)
    else:
        copies = materialize(copies, "repeats-copies")
        single = _matched(copies.join(crowds, "around", "left_anti")).union(_crowded(copies.join(crowds, "around", "left_semi")))
    return whole.union(single).groupBy("key").agg(F.collect_set(F.struct("low", "end")).alias("ranges"))


def _kept(text: bytes, ranges: list[dict] | None, copies: bool) -> tuple[int, int, bytes]:
    """(bytes removed, runs removed, rest)."""
    if copies and len(text) >= LENGTH:
        return len(text), 1, b""
    if not ranges:
        return 0, 0, text
    spans = sorted((r["low"], r["end"]) for r in ranges)
    rest, at, runs = [], 0, 0
    for low, end in spans:
        if low > at or not runs:
            rest.append(text[at:low])
            runs += 1
        at = max(at, end)
    rest.append(text[at:])
    kept = b"".join(rest)
    return len(text) - len(kept), runs, kept


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes), a row per row of ``docs(doc_id, text)``.

    Texts are UTF-8 bytes, NULL as empty; strings of 200 bytes are judged on the input. A repeated row is a copy.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", text_key())
    copies = rows.groupBy("key").count().where("count > 1").select("key", F.lit(True).alias("copies"))
    found = materialize(repeated_ranges(rows).join(copies, "key", "full"), "repeats-ranges")
    # Texts that a filter of fixed size proves to have no ranges stay where they are; only the others are joined.
    keyed = found.select(F.xxhash64("key").alias("cell"))
    some = _filter(keyed, "cell")

    @F.pandas_udf(T.BooleanType())
    def may_have(cell: pd.Series) -> pd.Series:
        return pd.Series(marked(some.value, _cell(cell.to_numpy())))

    rows = rows.withColumn("maybe", may_have(F.xxhash64("key")))
    joined = rows.where("maybe").join(found, "key", "left").select("doc_id", "text", "ranges", F.coalesce("copies", F.lit(False)).alias("copies"))
    untouched = rows.where("not maybe").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.col("text").cast("binary").alias("kept"))

    def cut(batches):
        for batch in batches:
            texts = text_bytes(batch)
            out = [_kept(t, r, c) for t, r, c in zip(texts, batch.column("ranges").to_pylist(), batch.column("copies").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([o[0] for o in out], pa.int64()),
                 pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary").union(untouched)


def op7_repeated_bytes(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
