"""Near-duplicate lines by an exact set-similarity join.

A line is its set of words; lines with equal sets are one set. A set's words are put in order of rarity: two sets with Jaccard
similarity of at least 0.8 share one of their first words (their prefixes), or two of them if the first is frequent. Sets that
share such a signature meet, in order of their sizes, and pairs that a bitmap bound does not rule out are candidates. A line
goes if an earlier line is equal or similar, so one similar set is enough: a set's closest earlier candidate is verified on the
whole sets first, and all its other candidates only if that one is not similar. The rows passed on grow with the sets, not with
the pairs of a group of variants.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordercraft.llm.words import count_cells, free, mark_cells, marked, materialize, maybe_in, mix64, slices, text_bytes, word_hashes

# Jaccard threshold 4/5, so that the bounds are exact in integers.
NUM, DEN = 4, 5
# Words are counted, for the rarity order, in a table of fixed size, a cell per hash value. Any order gives the same result.
FREQUENCY_BITS = 23
FILTER_BITS = 26
RARITY_STEPS = 8  # the order uses the logarithm of the count, in steps of 1/8
HOT = 100_000  # sets that share a word counted more often than this meet by two words
RANK_BITS = 8
BROADCAST_ROWS = 200_000
SEEN = 500_000  # sets that a task remembers, to pass on each set's words once
BLOCK = 1 << 16  # rows that a task compares at a time; in larger groups only some pairs are compared before the second round
NEAR = 64  # neighbours compared in those

PLACE_NULL = -(1 << 63)  # stands for a NULL doc_id, which comes first
TAG_BITS = 24  # of a set's key, to tell apart sets at one place (rows that repeat a doc_id)
GIVEN = 1 << 60  # added to the place in a document with an id

WORD_BITS = 50  # of a word's hash that are kept: with the line's number they sort as one integer
LINES = 1 << (64 - WORD_BITS)  # so many lines at a time


def _word_sets(lines: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """For up to ``LINES`` lines at a time, of those with words: index, start and size of the set, the sets' distinct words
    (sorted in each)."""
    for low in range(0, len(lines), LINES):
        words, owner = word_hashes(lines[low:low + LINES])
        if not len(words):
            continue
        keyed = np.sort((owner.astype(np.uint64) << np.uint64(WORD_BITS)) | (words >> np.uint64(64 - WORD_BITS)))
        keyed = keyed[np.r_[True, keyed[1:] != keyed[:-1]]]
        owner = (keyed >> np.uint64(WORD_BITS)).astype(np.int64)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        yield owner[starts] + low, starts, np.diff(np.append(starts, len(owner))), keyed & np.uint64((1 << WORD_BITS) - 1)


def _line_sets(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Text index and line number, then as ``_word_sets``, of all lines of the texts."""
    lines, text_of, number = [], [], []
    for n, text in enumerate(texts):
        parts = text.split(b"\n")
        lines += parts
        text_of += [n] * len(parts)
        number += range(len(parts))
    text_of, number = np.array(text_of, np.int64), np.array(number, np.int64)
    for line, *sets in _word_sets(lines):
        yield text_of[line], number[line], *sets


def word_rarity(docs: DataFrame, bits: int = FREQUENCY_BITS) -> np.ndarray:
    """Logarithm of the number of times that each word's cell occurs, in steps, one byte a cell."""
    def cells(batch: pa.RecordBatch):
        texts = text_bytes(batch)
        for i, j in slices([len(t) for t in texts]):
            yield (word_hashes(texts[i:j])[0] >> np.uint64(64 - bits)).astype(np.int64)

    counts = count_cells(docs.where(F.col("text").isNotNull()).select("text"), cells, bits)
    out = np.empty(len(counts), np.uint8)
    for i in range(0, len(counts), 1 << 18):
        out[i:i + (1 << 18)] = np.minimum(255, np.floor(RARITY_STEPS * np.log2(counts[i:i + (1 << 18)] + 1.0)))
    return out


def _set_keys(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit key of each set, of any order of its words."""
    return np.add.reduceat(mix64(words), starts), np.add.reduceat(mix64(words ^ np.uint64(0xD6E8FEB86659FD93)), starts)


def _at(given: np.ndarray, number: np.ndarray, h1: np.ndarray) -> np.ndarray:
    """Place of a set in its document, as an integer in the order of the lines; its last bits are the set's tag."""
    return (number << TAG_BITS) + (h1 >> np.uint64(64 - TAG_BITS)).astype(np.int64) + given


def _signatures(line: np.ndarray, at: np.ndarray, size: np.ndarray, word: np.ndarray, rare: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(line, signature, short)`` by words in order: ``at`` is a word's place in the order of its line's words.

    The first word that two similar sets share has at most size/5 words before it, and at most size/9 in the smaller set
    (``short``). Where it is hot, the sets meet by it and the next one that they share.
    """
    first = at <= size // DEN
    single = np.flatnonzero(first & ~rare & ~hot)
    out = [(line[single], word[single], at[single] <= size[single] // (NUM + DEN))]
    one = np.flatnonzero(first & hot)
    step = 1
    while len(one):
        one = one[(at[one] + step < size[one]) & (at[one] + step <= size[one] // DEN + 1)]
        two = one + step
        both = (mix64((word[one].astype(np.uint64) << np.uint64(32)) | word[two].astype(np.uint64)) >> np.uint64(32)).astype(np.uint32)
        out.append((line[one], both, at[two] - 1 <= size[one] // (NUM + DEN)))
        step += 1
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _lines(docs: DataFrame, rarity) -> DataFrame:
    """A row per line with words: place and set key; ``info`` once per set and task, of sets that can be similar to others:
    place tag, size, bitmap of parities and signatures, of which the first ``short`` hold for the smaller set too."""
    info = "struct<size: bigint, b1: bigint, b2: bigint, short: int, words: array<int>>"

    def lines(batches):
        seen: set[tuple] = set()
        ranks = rarity.value
        frequent = int(RARITY_STEPS * np.log2(HOT + 1.0))
        rest = 64 - RANK_BITS - (64 - WORD_BITS)
        for batch in batches:
            ids, texts = batch.column("doc_id"), text_bytes(batch)
            for i, j in slices([len(t) for t in texts]):
                for text, number, starts, size, words in _line_sets(texts[i:j]):
                    h1, h2 = _set_keys(words, starts)
                    # smaller sets are similar to equal ones only; a task may forget sets, which only repeats rows
                    fresh = (size >= NUM) & np.array(
                        [k not in seen and not seen.add(k) for k in zip(h1.tolist(), h2.tolist(), strict=True)], bool)
                    if len(seen) >= SEEN:
                        seen.clear()
                    bits = np.uint64(1) << (words & np.uint64(63))
                    upper = (words & np.uint64(64)) != 0
                    b1 = np.bitwise_xor.reduceat(np.where(upper, np.uint64(0), bits), starts)
                    b2 = np.bitwise_xor.reduceat(np.where(upper, bits, np.uint64(0)), starts)
                    line = np.repeat(np.arange(len(starts)), size)
                    rank = ranks[(words >> np.uint64(WORD_BITS - FREQUENCY_BITS)).astype(np.int64)].astype(np.uint64)
                    order = np.sort((line.astype(np.uint64) << np.uint64(WORD_BITS)) | (rank << np.uint64(rest))
                                    | (words & np.uint64((1 << rest) - 1)))
                    at = np.arange(len(order)) - starts[line]
                    use = np.flatnonzero(fresh[line] & (at <= size[line] // DEN + 1))
                    line, at, order = line[use], at[use], order[use]
                    rank = ((order >> np.uint64(rest)) & np.uint64((1 << RANK_BITS) - 1)).astype(np.int64)
                    word = ((order >> np.uint64(rest - 32)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                    # a word that occurs once is in no other set, but holds its place in the order
                    line, word, short = _signatures(line, at, size[line], word, rank <= RARITY_STEPS, rank > frequent)
                    order = np.lexsort((~short, line))
                    line, word, short = line[order], word[order], short[order]
                    count = np.bincount(line, minlength=len(starts))
                    words = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)), pa.array(word.view(np.int32)))
                    found = pa.StructArray.from_arrays(
                        [pa.array(size), pa.array(b1.view(np.int64)), pa.array(b2.view(np.int64)),
                         pa.array(np.bincount(line[short], minlength=len(starts)).astype(np.int32)), words],
                        names=["size", "b1", "b2", "short", "words"], mask=pa.array(count == 0))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(text + i)), pa.array(number), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), found],
                        names=["doc_id", "line", "h1", "h2", "info"])

    return docs.where(F.col("text").isNotNull()).select("doc_id", "text").mapInArrow(
        lines, f"doc_id long, line long, h1 long, h2 long, info {info}")


def _met(sets: DataFrame) -> DataFrame:
    """A row per signature of a set: ``key`` (signature << 32 | size << 1 | short), place and bitmap."""
    rows = sets.where("info is not null").select("doc", "at", "info.*").select(
        "doc", "at", "size", "b1", "b2", "short", F.posexplode("words").alias("nth", "word"))
    key = F.shiftleft(F.col("word").cast("long"), 32) + F.shiftleft("size", 1) + (F.col("nth") < F.col("short")).cast("long")
    return rows.select(key.alias("key"), "doc", "at", "b1", "b2")


def _closest(met: DataFrame) -> DataFrame:
    """``doc_x, at_x, doc_y, at_y, differ, more``: for sets and their signatures, the candidate with the closest bitmap
    among earlier sets, and whether there may be others."""
    columns = ["doc_x", "at_x", "doc_y", "at_y", "differ", "more"]

    def compared(key, doc, at, b1, b2, cut):
        """Candidates among rows sorted by key; ``cut``: whether rows of the first or last signature are missing."""
        word, size, short = key >> 32, (key & 0xFFFFFFFF) >> 1, (key & 1) == 1
        n = len(key)
        edge = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        count = np.diff(np.append(edge, n))
        group_end = np.repeat(edge + count, count)
        large = ((word == word[0]) & cut[0]) | ((word == word[-1]) & cut[1])
        run = np.flatnonzero(np.r_[True, key[1:] >> 1 != key[:-1] >> 1])
        run = np.repeat(run, np.diff(np.append(run, n)))
        best, closest, found = np.full(n, 1 << 30), np.zeros(n, np.int64), np.zeros(n, np.int64)

        def meet(i, j):  # size[i] <= size[j]; no row twice in i, nor in j unless rows of i are all later
            use = short[i] | (short[j] & (size[i] == size[j]))
            i, j = i[use], j[use]
            total = size[i] + size[j]
            # unsigned: of a negative number, numpy counts the bits of its absolute value
            differ = sum(np.bitwise_count((b[i] ^ b[j]).view(np.uint64)).astype(np.int64) for b in (b1, b2))
            use = differ <= total - 2 * ((total * NUM + NUM + DEN - 1) // (NUM + DEN))
            i, j, differ = i[use], j[use], differ[use]
            line_i, line_j = at[i] >> TAG_BITS, at[j] >> TAG_BITS
            after = (doc[i] > doc[j]) | ((doc[i] == doc[j]) & (line_i > line_j))
            before = (doc[i] < doc[j]) | ((doc[i] == doc[j]) & (line_i < line_j))
            for use, x, y in ((after, i, j), (before, j, i)):
                x, y, d = x[use], y[use], differ[use]
                np.add.at(found, x, 1)
                better = d < best[x]
                x, y, d = x[better], y[better], d[better]
                best[x], closest[x] = d, y

        i, step = np.flatnonzero(group_end - np.arange(n) > 1), 1
        while len(i):
            i = i[i + step < group_end[i]]
            i = i[(size[i + step] * NUM <= size[i] * DEN) & (~large[i] | (step <= NEAR))]
            meet(i, i + step)
            step += 1
        for first in range(4):  # rows of equal size are sorted by place, after those that hold for larger sets only
            i = np.flatnonzero(large & (run + first < np.arange(n)))
            i = i[(i - run[i] - first > NEAR) & (run[i] + first < n)]
            meet(run[i] + first, i)
        x = np.flatnonzero((found > 0) | large)
        got = found[x] > 0
        y = np.where(got, closest[x], x)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[x]), pa.array(at[x]), pa.array(doc[y], mask=~got), pa.array(at[y], mask=~got), pa.array(best[x]),
             pa.array((found[x] > 1) | large[x])], names=columns)

    def closest(batches):
        held, rows, started = [], 0, False
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < BLOCK:
                continue
            table = pa.Table.from_batches(held)
            part = [table.column(c).to_numpy() for c in ("key", "doc", "at", "b1", "b2")]
            # the last signature's rows wait for the rest, unless they fill the block
            last = int(np.searchsorted(part[0] >> 32, part[0][-1] >> 32))
            whole = last > 0
            last = last if whole else rows
            yield compared(*(c[:last] for c in part), (started, not whole))
            held, rows, started = table.slice(last).to_batches(), rows - last, not whole
        if rows:
            table = pa.Table.from_batches(held)
            yield compared(*(table.column(c).to_numpy() for c in ("key", "doc", "at", "b1", "b2")), (started, False))

    ordered = met.repartition(F.shiftright("key", 32)).sortWithinPartitions("key", "doc", "at")
    return ordered.mapInArrow(closest, "doc_x long, at_x long, doc_y long, at_y long, differ long, more boolean")


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _doc_cell(doc: np.ndarray) -> np.ndarray:
    return _cell(mix64(doc.view(np.uint64)))


def _line_cell(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    return _cell(mix64(doc.view(np.uint64) ^ mix64((at >> TAG_BITS).view(np.uint64))))


def _task_sets(docs: DataFrame, some) -> DataFrame:
    """``doc, at, set`` (sorted word hashes) of the lines that are in a filter of fixed size, by document and by place."""
    def sets(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            doc = ids.fill_null(PLACE_NULL).to_numpy(zero_copy_only=False)
            given = np.where(np.asarray(ids.is_valid()), GIVEN, 0)
            hit = np.flatnonzero(marked(some.value, _doc_cell(doc)))
            texts = text_bytes(batch.select(["text"]).take(pa.array(hit)))
            lines, text_of, number = [], [], []
            for n, text in zip(hit, texts, strict=True):
                parts = text.split(b"\n")
                at = (np.arange(len(parts)) << TAG_BITS) + given[n]
                wanted = np.flatnonzero(marked(some.value, _line_cell(np.full(len(parts), doc[n]), at)))
                lines += [parts[k] for k in wanted]
                text_of += [n] * len(wanted)
                number += wanted.tolist()
            text_of, number = np.array(text_of, np.int64), np.array(number, np.int64)
            for i, j in slices([len(x) for x in lines]):
                for line, starts, size, words in _word_sets(lines[i:j]):
                    at = _at(given[text_of[line + i]], number[line + i], _set_keys(words, starts)[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc[text_of[line + i]]), pa.array(at),
                         pa.array([words[a:a + n].tobytes() for a, n in zip(starts, size, strict=True)], pa.binary())],
                        names=["doc", "at", "set"])

    return docs.where(F.col("text").isNotNull()).select("doc_id", "text").mapInArrow(sets, "doc long, at long, set binary")


def _similar(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """``doc, at, h1, h2`` of the sets x with a pair ``(doc_x, at_x, doc_y, at_y)`` whose Jaccard similarity is at least 0.8, written.

    The sets' words are read from the documents again, only from lines that a filter of fixed size holds, so that no text is
    shuffled.
    """
    sides = [[F.col(f"{c}_{x}").alias(c) for c in ("doc", "at")] for x in "xy"]
    wanted = materialize(pairs.select(*sides[0]).union(pairs.select(*sides[1])).distinct(), "lines-wanted")

    def cells(batch: pa.RecordBatch) -> np.ndarray:
        doc, at = (batch.column(c).to_numpy() for c in ("doc", "at"))
        return np.concatenate([_doc_cell(doc), _line_cell(doc, at)])

    some = docs.sparkSession.sparkContext.broadcast(mark_cells(wanted, cells, FILTER_BITS))
    # grouped by place, so that both joins read the sets from one shuffle
    sets = _task_sets(docs, some).groupBy("doc", "at").agg(F.collect_set("set").alias("sets"))
    both = pairs
    for x in "xy":
        side = sets.select(F.col("doc").alias(f"doc_{x}"), F.col("at").alias(f"at_{x}"), F.explode("sets").alias(f"set_{x}"))
        both = both.join(side, [f"doc_{x}", f"at_{x}"])

    def verify(batches):
        for batch in batches:
            keep, keys = [], []
            for x, y in zip(batch.column("set_x").to_pylist(), batch.column("set_y").to_pylist(), strict=True):
                words = np.frombuffer(x, np.uint64)
                common = len(np.intersect1d(words, np.frombuffer(y, np.uint64), assume_unique=True))
                keep.append(common * DEN >= NUM * ((len(x) + len(y)) // 8 - common))
                keys.append([h[0] for h in _set_keys(words, np.zeros(1, np.int64))])
            keys = np.array(keys, np.uint64).reshape(-1, 2).view(np.int64)
            columns = [batch.column("doc_x"), batch.column("at_x"), pa.array(keys[:, 0]), pa.array(keys[:, 1])]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in columns], names=["doc", "at", "h1", "h2"])

    found = both.select("doc_x", "at_x", "set_x", "set_y").mapInArrow(verify, "doc long, at long, h1 long, h2 long")
    found = materialize(found.distinct(), "lines-similar")
    some.destroy()
    return found


def _others(met: DataFrame, open_: DataFrame) -> DataFrame:
    """Every candidate ``(doc_x, at_x, doc_y, at_y)`` of the sets ``open_(doc, at)`` among earlier sets, written."""
    rows = materialize(met.join(open_, ["doc", "at"]), "lines-open")
    # Counted first: up to so many rows (56 bytes each) are sent to the tasks, more meet by a shuffle.
    rows = F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows
    x, y = (side.select(F.shiftright("key", 32).alias(f"word_{n}"), F.shiftright(F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)), 1).alias(f"size_{n}"),
                        F.col("key").bitwiseAND(F.lit(1)).alias(f"short_{n}"), *[F.col(c).alias(f"{c}_{n}") for c in ("doc", "at", "b1", "b2")])
            for side, n in ((rows, "x"), (met, "y")))
    line = F.shiftright("at_x", TAG_BITS), F.shiftright("at_y", TAG_BITS)
    earlier = (F.col("doc_y") < F.col("doc_x")) | ((F.col("doc_y") == F.col("doc_x")) & (line[1] < line[0]))
    total = F.col("size_x") + F.col("size_y")
    differ = F.bit_count(F.col("b1_x").bitwiseXOR(F.col("b1_y"))) + F.bit_count(F.col("b2_x").bitwiseXOR(F.col("b2_y")))
    short = F.expr("(size_x <= size_y and short_x = 1) or (size_y <= size_x and short_y = 1)")
    near = (F.col("size_x") * DEN >= F.col("size_y") * NUM) & (F.col("size_y") * DEN >= F.col("size_x") * NUM) & (
        differ <= total - 2 * F.expr(f"((size_x + size_y) * {NUM} + {NUM + DEN - 1}) div {NUM + DEN}"))
    pairs = y.join(x, F.col("word_x") == F.col("word_y")).where(near & short & earlier)
    return materialize(pairs.select("doc_x", "at_x", "doc_y", "at_y").distinct(), "lines-others")


def removed_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, line`` (from 0) of every line of ``docs(doc_id, text)`` that an earlier line makes redundant.

    Earlier is by (doc_id, line), NULL doc_ids first; the earlier line may itself be removed. Lines without words stay. Rows
    that repeat a doc_id are one document: lines at the same place are not earlier than each other.
    """
    rarity = docs.sparkSession.sparkContext.broadcast(word_rarity(docs))
    lines = materialize(_lines(docs, rarity), "lines")
    rarity.destroy()
    place = F.struct("doc_id", "line")
    sets = lines.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.count("*").alias("n"), F.first("info", ignorenulls=True).alias("info"))
    tag = F.shiftrightunsigned("h1", 64 - TAG_BITS)
    sets = materialize(sets.select(
        "h1", "h2", "first", "n", "info", F.coalesce("first.doc_id", F.lit(PLACE_NULL)).alias("doc"),
        (F.shiftleft("first.line", TAG_BITS) + tag + F.when(F.col("first.doc_id").isNull(), 0).otherwise(GIVEN)).alias("at")), "lines-first")
    met = _met(sets)
    y = F.struct("doc_y", "at_y")
    closest = _closest(met).groupBy("doc_x", "at_x").agg(
        F.min(F.when(F.col("at_y").isNotNull(), F.struct("differ", "doc_y", "at_y"))).alias("best"),
        (F.max("more") | F.coalesce(F.min(y) != F.max(y), F.lit(False))).alias("more"))
    closest = materialize(closest.select("doc_x", "at_x", "best.doc_y", "best.at_y", "more"), "lines-closest")
    similar = _similar(closest.where("at_y is not null").drop("more"), docs)
    open_ = materialize(closest.where("more").select(F.col("doc_x").alias("doc"), F.col("at_x").alias("at")).join(
        similar, ["doc", "at"], "left_anti"), "lines-unsettled")
    if not open_.isEmpty():
        similar = similar.union(_similar(_others(met, open_), docs))
    gone = sets.where("n > 1").select("h1", "h2", "first").union(similar.select("h1", "h2", F.lit(None).cast(sets.schema["first"].dataType)))
    return lines.select(place.alias("place"), "h1", "h2").join(gone, ["h1", "h2"]).where(
        F.col("first").isNull() | (F.col("place") != F.col("first"))).select("place.*").distinct()


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_lines`` and ``removed`` (sorted line numbers, from 0) added (same-named columns are replaced).

    A row per row; NULL text has no lines, an empty text has one.
    """
    docs = docs.drop("n_lines", "removed").withColumn(
        "n_lines", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long"))
    doc = free(docs, "_doc")
    gone = removed_lines(docs).groupBy(F.col("doc_id").alias(doc)).agg(F.array_sort(F.collect_list("line")).alias("removed"))
    gone = materialize(gone, "lines-removed")
    none = F.array().cast("array<long>")
    # only documents that may have removed lines are shuffled, with their text only if it is selected
    test = maybe_in(gone, doc)
    some = docs.where(test("doc_id")).join(gone, F.col("doc_id").eqNullSafe(F.col(doc)), "left").drop(doc)
    some = some.withColumn("removed", F.when(F.col("n_lines") > 0, F.coalesce("removed", none)).otherwise(none))
    return some.unionByName(docs.where(~test("doc_id")).withColumn("removed", none))


def without_removed(text: Column, removed: Column) -> Column:
    """The text without its removed lines."""
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0).cast("long"), F.size(lines).cast("long") - 1), removed)
    return F.when(F.size(removed) == 0, text).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i.cast("int"))), "\n"))


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join(
            F.transform("removed", lambda n: n.cast("string")), ",").alias("removed_lines"))


ORACLE = r"""
with line as (
  select doc_id, unnest(range(0, len(l))) line, list_distinct(regexp_extract_all(
           translate(unnest(l), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) w
  from (select doc_id, string_split(text, chr(10)) l from documents where text is not null)),
sets as (
  select list_sort(w) w, min((doc_id, line)) first, row_number() over () id, len(any_value(w)) size from line where len(w) > 0 group by list_sort(w)),
word as (select id, size, unnest(w) word from sets),
frequency as (select word, count(*) f from word group by word),
prefix as (
  select id, size, word from (
    select word.*, row_number() over (partition by id order by f, word) place from word join frequency using (word))
  where place <= size - ceil(size * 0.8) + 1),
candidate as (
  select distinct a.id a, b.id b from prefix a join prefix b on a.word = b.word and a.id < b.id
  where a.size >= 0.8 * b.size and b.size >= 0.8 * a.size),
alike as (
  select x.id a, y.id b, x.first fa, y.first fb, len(list_intersect(x.w, y.w)) common, x.size + y.size total
  from candidate join sets x on x.id = candidate.a join sets y on y.id = candidate.b),
later as (select distinct case when fa < fb then b else a end id from alike where common * 5 >= 4 * (total - common)),
gone as (
  select line.doc_id, line.line from line join sets on list_sort(line.w) = sets.w left join later using (id)
  where later.id is not null or (line.doc_id, line.line) <> sets.first),
per_doc as (select doc_id, count(*) n, string_agg(line, ',' order by line) removed from gone group by doc_id)
select d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::bigint n_lines, coalesce(p.n, 0)::bigint n_removed, coalesce(p.removed, '') removed_lines
from documents d left join per_doc p using (doc_id)
"""
