"""Near-duplicate documents by consistent weighted sampling.

A document is its 5-word shingles with TF-IDF weights. Improved consistent weighted sampling draws, for each of
``HASHES`` hash functions, one (shingle, level) such that two documents draw the same one with probability equal to
their weighted Jaccard similarity. Draws are banded; documents that share a band are candidates, and a candidate is a
link only if the weighted Jaccard similarity of the whole texts, by exact document frequencies, reaches the threshold.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordercraft.llm.components import connected_components
from ordercraft.llm.words import count_cells, gram_hashes, materialize, mark_cells, marked, maybe_in, mix64, slices, text_bytes, text_key, whole, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 10, 4  # a pair at the threshold shares a band with probability 0.995
HASHES = BANDS * ROWS
# For drawing candidates, document frequencies are counted in a table of fixed size, a cell per hash value, over all
# documents. A cell's count is at least the frequency of each of its shingles: it bounds similarities, exact counts settle them.
FREQUENCY_BITS = 18
# idf = 1 + IDF_WEIGHT * ln(N / df) / ln(N): common shingles weigh less, but not so much less that the few edits of a near
# copy outweigh what it shares with many others.
IDF_WEIGHT = 0.25
RECALL = 0.999  # of the sampled estimate that candidates must pass
# A task holds two blocks: so many texts, and bytes of texts, at most (a longer text is a block of its own).
BLOCK_ROWS, BLOCK_BYTES = 2048, 8 << 20
_WORDS = -(-HASHES // 7)  # longs of a packed signature: 7 one-byte draws each
_LOW = 0x007F7F7F7F7F7F7F
_HIGH = 0x0080808080808080


def _gamma_quantiles() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at 2**16 midpoints, by bisection."""
    u = (np.arange(1 << 16) + 0.5) / (1 << 16)
    low, high = np.zeros(len(u)), np.full(len(u), 32.0)
    for _ in range(60):
        mid = (low + high) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < u
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return high


class Sampler:
    """Shingle weights from the idf of each hash cell, and signatures of many texts at a time."""

    def __init__(self, idf: np.ndarray, hashes: int = HASHES):
        self.idf = idf
        quantile = _gamma_quantiles()
        self.rate, self.log_cut = quantile.astype(np.float32), np.log(quantile).astype(np.float32)
        self.seeds = mix64(np.arange(1, hashes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def shingles(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owner, hash, weight) of the distinct shingles of each text, by owner and hash."""
        owner, hashes, tf = distinct_shingles(texts)
        return owner, hashes, tf * self.weight(hashes)

    def weight(self, hashes: np.ndarray) -> np.ndarray:
        return self.idf[(hashes >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)]

    def signatures(self, owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Owners with shingles, and their draws (owners x hashes, uint64)."""
        if not len(owner):
            return owner, np.zeros((0, len(self.seeds)), np.uint64)
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        log_w = np.log(weights).astype(np.float32)
        index = np.arange(len(owner), dtype=np.uint64)
        out = np.empty((len(starts), len(self.seeds)), np.uint64)
        for k, seed in enumerate(self.seeds):
            x = hashes * seed
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            rate = self.rate[x >> np.uint64(48)]
            shift = ((x >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.float32) * np.float32(2.0**-16)
            level = np.floor(log_w / rate + shift)
            cost = self.log_cut[(x >> np.uint64(32)) & np.uint64(0xFFFF)] - rate * (level - shift + 1)
            # positive floats order as their bits: smallest cost and its index in one minimum
            packed = ((cost + np.float32(256)).view(np.uint32).astype(np.uint64) << np.uint64(32)) | index
            at = (np.minimum.reduceat(packed, starts) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            out[:, k] = mix64(hashes[at] + level[at].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + seed)
        return owner[starts], out


def text_shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of every 5-word shingle, owners in order; a text of 1 to 4 words is one shingle."""
    words, owner = word_hashes(texts)
    inside = whole(owner, SHINGLE)
    owners, hashes = [owner[:len(inside)][inside]], [gram_hashes(words, SHINGLE)[inside]]
    count = np.bincount(owner, minlength=len(texts))
    for text in np.flatnonzero((count > 0) & (count < SHINGLE)):
        first = np.searchsorted(owner, text)
        owners.append(np.array([text]))
        hashes.append(gram_hashes(words[first:first + count[text]], int(count[text])))
    owners, hashes = np.concatenate(owners), np.concatenate(hashes)
    order = np.argsort(owners, kind="stable")
    return owners[order], hashes[order]


def distinct_shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, hash, count) of the distinct shingles of each text, by owner and hash."""
    owner, hashes = text_shingles(texts)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])]) if len(owner) else owner
    return owner[new], hashes[new], np.diff(np.append(new, len(owner)))


def frequency_table(texts: DataFrame, bits: int = FREQUENCY_BITS) -> np.ndarray:
    """Documents per shingle hash cell, over all rows of ``texts(text)``."""
    def cells(batch: pa.RecordBatch):
        raw = text_bytes(batch)
        for i, j in slices([len(t) for t in raw]):
            owner, hashes = text_shingles(raw[i:j])
            cell = (hashes >> np.uint64(64 - bits)).astype(np.int64)
            yield np.unique((owner << bits) | cell) & ((1 << bits) - 1)

    return count_cells(texts.where(F.col("text").isNotNull()).select("text"), cells, bits)


def damped_idf(frequency: np.ndarray, n: int) -> np.ndarray:
    return 1 + IDF_WEIGHT * np.log(n / np.clip(frequency, 1, n)) / math.log(n)


def counted_texts(texts: DataFrame, present: DataFrame) -> DataFrame:
    """``texts(key, text)`` with ``often``, written: the text's shingles that several rows of ``present(text)`` hold, as
    (shingle, n) with the exact number of rows. All its other shingles are in one row.

    Shingles of ``present`` that a filter of fixed size rules out are in no wanted text and are not shuffled.
    """
    bits = 26

    def cell(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - bits)).astype(np.int64)

    def cells(batch: pa.RecordBatch) -> np.ndarray:
        raw = text_bytes(batch)
        return np.concatenate([np.zeros(0, np.int64), *(np.unique(cell(text_shingles(raw[i:j])[1])) for i, j in slices([len(t) for t in raw]))])

    some = texts.sparkSession.sparkContext.broadcast(mark_cells(texts.select("text"), cells, bits))

    def count(batches):
        for batch in batches:
            raw = text_bytes(batch)
            for i, j in slices([len(t) for t in raw]):
                _, hashes, _ = distinct_shingles(raw[i:j])
                found, n = np.unique(hashes[marked(some.value, cell(hashes))], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["shingle", "n"])

    def held(batches):
        for batch in batches:
            raw, keys = text_bytes(batch), batch.column("key")
            for i, j in slices([len(t) for t in raw]):
                owner, hashes, _ = distinct_shingles(raw[i:j])
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(owner + i)), pa.array(hashes.view(np.int64))], names=["key", "shingle"])

    counts = present.select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1")
    often = texts.mapInArrow(held, "key binary, shingle long").join(counts, "shingle").groupBy("key").agg(
        F.collect_list(F.struct("shingle", "n")).alias("often"))
    return materialize(texts.join(often, "key", "left"), "minhash-counted")


def exact_weights(owner: np.ndarray, hashes: np.ndarray, often: list, n: int) -> np.ndarray:
    """idf of distinct shingles, by owner and hash; ``often[o]`` are the ``counted_texts`` entries of owner ``o``."""
    frequency = np.ones(len(hashes), np.int64)
    cut = np.searchsorted(owner, np.arange(len(often) + 1))
    for o, entries in enumerate(often):
        if entries is not None and len(entries):
            shingle = entries.field("shingle").to_numpy(zero_copy_only=False).view(np.uint64)
            frequency[cut[o] + np.searchsorted(hashes[cut[o]:cut[o + 1]], shingle)] = entries.field("n").to_numpy(zero_copy_only=False)
    return damped_idf(frequency, n)


def _often(batch, name: str) -> list:
    """A row's ``often`` entries, as an Arrow array of structs, or None."""
    column = batch.column(name)
    return [x.values for chunk in (column.chunks if isinstance(column, pa.ChunkedArray) else [column]) for x in chunk]


def _least_matches() -> int:
    """Draws that a pair at the threshold has in common with probability ``RECALL`` at least."""
    tail = 0.0
    for k in range(HASHES, -1, -1):
        tail += math.comb(HASHES, k) * THRESHOLD**k * (1 - THRESHOLD) ** (HASHES - k)
        if tail >= RECALL:
            return k
    return 0


def _matches(a: str, b: str) -> Column:
    """Common draws of two packed signatures: zero bytes of their exclusive or."""
    count = F.lit(-(_WORDS * 7 - HASHES))  # unused bytes are always equal
    for k in range(_WORDS):
        x = F.col(f"{a}.w{k}").bitwiseXOR(F.col(f"{b}.w{k}"))
        nonzero = (x.bitwiseAND(F.lit(_LOW)) + F.lit(_LOW)).bitwiseOR(x)
        count = count + F.bit_count(F.bitwise_not(nonzero).bitwiseAND(F.lit(_HIGH)))
    return count


def _signatures(docs: DataFrame, idf) -> DataFrame:
    """``key, doc_id, bands, sig`` per document; NULL bands and sig for a text without words."""
    def sign(batches):
        sampler = Sampler(idf.value)
        for batch in batches:
            keys, texts = batch.column("key").to_pylist(), text_bytes(batch)
            distinct: dict[bytes, int] = {}
            for i, key in enumerate(keys):
                distinct.setdefault(key, i)
            at = list(distinct.values())
            where = {key: n for n, key in enumerate(distinct)}
            bands: list = [None] * len(at)
            packed = np.zeros((len(at), _WORDS), np.int64)
            for i, j in slices([len(texts[a]) for a in at], 1 << 20):
                owner, draws = sampler.signatures(*sampler.shingles([texts[a] for a in at[i:j]]))
                band = np.zeros((len(owner), BANDS), np.uint64)
                for r in range(ROWS):
                    band = mix64(band + draws[:, r::ROWS])
                small = np.zeros((len(owner), _WORDS * 7), np.uint64)
                small[:, :HASHES] = draws & np.uint64(0xFF)
                words = (small.reshape(len(owner), _WORDS, 7) << (np.arange(7, dtype=np.uint64) * np.uint64(8))).sum(axis=2, dtype=np.uint64)
                for n, o in enumerate(owner):
                    bands[i + o] = band[n].view(np.int64).tolist()
                packed[i + owner] = words.view(np.int64)
            row = np.array([where[k] for k in keys], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), pa.array([bands[r] for r in row], pa.list_(pa.int64())),
                 *[pa.array(packed[row, w]) for w in range(_WORDS)]],
                names=["key", "doc_id", "bands", *[f"w{w}" for w in range(_WORDS)]])

    schema = "key binary, doc_id long, bands array<long>, " + ", ".join(f"w{w} long" for w in range(_WORDS))
    found = docs.mapInArrow(sign, schema)
    return found.select("key", "doc_id", "bands", F.struct(*[f"w{w}" for w in range(_WORDS)]).alias("sig"))


def _side_by_side(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs(a, b)`` with the other columns of ``texts(key, ...)`` for each."""
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(*[F.col(c).alias(side if c == "key" else f"{c}_{side}") for c in texts.columns]), side)
    return pairs


def _sums(owner: np.ndarray, hashes: np.ndarray, tf: np.ndarray, pairs: int):
    """Texts 2n and 2n + 1 are pair n: (pair, hash, smaller count, difference of counts) of the pairs' shingles."""
    pair = owner >> 1
    order = np.lexsort((hashes, pair))
    p, h, t = pair[order], hashes[order], tf[order]
    same = np.flatnonzero((p[1:] == p[:-1]) & (h[1:] == h[:-1]))
    first = np.ones(len(p), bool)
    first[same + 1] = False
    low, high = np.zeros(len(p), np.int64), t.copy()
    low[same], high[same] = np.minimum(t[same], t[same + 1]), np.maximum(t[same], t[same + 1])
    return order[first], p[first], h[first], low[first], (high - low)[first]


def _paired(batch, columns: tuple[str, str] = ("text_a", "text_b")):
    """(i, j, shingles) of runs of rows i to j, whose texts are taken in pairs."""
    left, right = (text_bytes(batch, c) for c in columns)
    for i, j in slices([len(x) + len(y) for x, y in zip(left, right, strict=True)]):
        yield i, j, distinct_shingles([t for p in zip(left[i:j], right[i:j], strict=True) for t in p])


def _bounded(pairs: DataFrame, texts: DataFrame, idf, n: int) -> DataFrame:
    """``a, b, sure`` of the pairs whose weighted Jaccard similarity may reach the threshold; ``sure`` if it does.

    A shingle is in at least one row (two, if both texts have it) and in at most as many as its cell counts.
    """
    def bound(batches):
        sampler = Sampler(idf.value)
        one, two = damped_idf(np.array([1, 2]), n)
        for batch in batches:
            may, sure = np.zeros(batch.num_rows, bool), np.zeros(batch.num_rows, bool)
            for i, j, (owner, hashes, tf) in _paired(batch):
                _, p, h, low, rest = _sums(owner, hashes, tf, j - i)
                least, most = sampler.weight(h), np.where(low > 0, two, one)
                total = lambda x: np.bincount(p, x, minlength=j - i)
                inner = total(low * least)
                sure[i:j] = (inner > 0) & (inner >= THRESHOLD * (inner + total(rest * most)) * (1 + 1e-9))
                inner = total(low * most)
                may[i:j] = (inner > 0) & (inner >= THRESHOLD * (inner + total(rest * least)) * (1 - 1e-9))
            may = pa.array(may | sure)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(may), batch.column("b").filter(may), pa.array(sure).filter(may)],
                                             names=["a", "b", "sure"])

    both = _side_by_side(pairs, texts)
    return both.select("a", "b", "text_a", "text_b").mapInArrow(bound, "a binary, b binary, sure boolean")


def _verified(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """The pairs ``(a, b)`` whose weighted Jaccard similarity reaches the threshold; ``texts`` of ``counted_texts``."""
    def verify(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            often = [x for p in zip(_often(batch, "often_a"), _often(batch, "often_b"), strict=True) for x in p]
            for i, j, (owner, hashes, tf) in _paired(batch):
                at, p, _, low, rest = _sums(owner, hashes, tf, j - i)
                weight = exact_weights(owner, hashes, often[2 * i:2 * j], n)[at]
                inner, other = np.bincount(p, low * weight, minlength=j - i), np.bincount(p, rest * weight, minlength=j - i)
                keep[i:j] = (inner >= THRESHOLD * (inner + other) * (1 - 1e-12)) & (inner > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])

    both = _side_by_side(pairs, texts)
    return both.select("a", "b", "text_a", "text_b", "often_a", "often_b").mapInArrow(verify, "a binary, b binary")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id``: a row per row of ``docs(doc_id, text)``; class_id is the smallest doc_id of the class.

    Equal texts are one class; classes are linked if their weighted Jaccard similarity is at least 0.8, and class_id is
    that of the connected component. Texts without words link with equal texts only, NULL texts with nothing (class_id is
    their own doc_id). Rows that repeat a doc_id are one document. A class of NULL doc_ids alone has a NULL class_id.

    In each bucket (band value) every text is compared with the bucket's first and last key. Buckets whose texts these
    links leave in different components are then compared pair by pair, block by block inside tasks. No bucket is cut.
    """
    keyed = docs.select("doc_id", "text", text_key().alias("key"))
    present = keyed.where(F.col("text").isNotNull())
    n = max(present.count(), 2)
    idf = docs.sparkSession.sparkContext.broadcast(damped_idf(frequency_table(present), n))
    signed = materialize(_signatures(present.select("key", "doc_id", "text"), idf), "minhash-signed")
    classes = materialize(
        signed.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("sig").alias("sig")),
        "minhash-classes")

    rows = classes.where("bands is not null").select("key", "sig", F.posexplode("bands").alias("band", "value"))
    bucket = ["band", "value"]
    ends = rows.groupBy(*bucket).agg(
        F.count("*").alias("n"), F.min(F.struct("key", "sig")).alias("low"), F.max(F.struct("key", "sig")).alias("high")).where("n > 1")
    ends = materialize(ends.drop("n"), "minhash-buckets")
    alike = F.lit(_least_matches())
    buckets = materialize(rows.join(ends.select(*bucket), bucket, "left_semi"), "minhash-rows")
    star = buckets.join(ends, bucket).select("key", "sig", F.explode(F.array("low", "high")).alias("end")).where(
        (F.col("key") != F.col("end.key")) & (_matches("sig", "end.sig") >= alike)).select(
        F.least("key", "end.key").alias("a"), F.greatest("key", "end.key").alias("b")).distinct()
    star = materialize(star, "minhash-pairs")
    first = _link(star, present, classes, idf, n)
    parts = connected_components(first)

    placed = materialize(_component(buckets, parts), "minhash-placed")
    # up to three texts, the two ends have met all pairs
    open_ = placed.groupBy(*bucket).agg(F.count("*").alias("n"), F.min("component").alias("c"), F.max("component").alias("d")).where(
        "n > 3 and c <> d").select(*bucket)
    rest = materialize(placed.join(materialize(open_, "minhash-open"), bucket), "minhash-rest")
    if not rest.isEmpty():
        texts = counted_texts(_texts(rest.select("key"), present, classes), present)
        blocks = F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int")
        sized = rest.join(texts.select("key", F.octet_length("text").alias("bytes")), "key").groupBy(*bucket).agg(blocks.alias("blocks"))
        rest = rest.join(materialize(sized, "minhash-blocks"), bucket).join(classes.select("key", "bands"), "key").join(texts, "key")
        parts = connected_components(first.union(materialize(_compared(rest, n), "minhash-links")))

    members = materialize(_component(signed.select("key", "doc_id"), parts), "minhash-members")
    smallest = members.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    return members.join(smallest, "component").select("doc_id", "class_id").union(
        keyed.where(F.col("text").isNull()).select("doc_id", F.col("doc_id").alias("class_id")))


def _component(rows: DataFrame, parts: DataFrame) -> DataFrame:
    return rows.join(parts.withColumnRenamed("id", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))


def _texts(keys: DataFrame, present: DataFrame, classes: DataFrame) -> DataFrame:
    """``key, text``, written: the text of one document of each wanted class is fetched, by its id and content.

    Other texts are not shuffled, but for the few that a filter of fixed size lets through.
    """
    wanted = materialize(
        classes.join(keys.distinct(), "key", "left_semi").select(F.col("key").alias("_key"), F.col("doc_id").alias("_doc_id")),
        "minhash-wanted")
    texts = present.where(maybe_in(wanted, "_key")("key")).join(wanted, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left_semi")
    return materialize(texts.select("key", "text").dropDuplicates(["key"]), "minhash-texts")


def _link(pairs: DataFrame, present: DataFrame, classes: DataFrame, idf, n: int) -> DataFrame:
    """The pairs that are links, written: those that the bounds settle, and those that exact frequencies do."""
    def texts_of(rows: DataFrame) -> DataFrame:
        return _texts(rows.select(F.col("a").alias("key")).union(rows.select(F.col("b").alias("key"))), present, classes)

    may = materialize(_bounded(pairs, texts_of(pairs), idf, n), "minhash-bounded")
    links, open_ = may.where("sure").select("a", "b"), may.where("not sure").select("a", "b")
    if open_.isEmpty():
        return links
    return links.union(materialize(_verified(open_, counted_texts(texts_of(open_), present), n), "minhash-links"))


def _compared(rows: DataFrame, n_rows: int) -> DataFrame:
    """Links ``(a, b)`` that join the components of the rows' buckets: ``band, value, blocks, key, component, sig, bands, text, often``.

    A bucket is dealt out as pairs of blocks. A task takes the pairs of its two blocks, most alike first, skips those whose
    texts are joined already (by a component or by its own links) or meet in an earlier band, and verifies the others.
    """
    least = _least_matches()

    def compare(group: pa.Table) -> pa.Table:
        band, low, high = (group.column(c)[0].as_py() for c in ("band", "low", "high"))
        block = group.column("block").to_numpy()
        sig = np.stack([group.column(f"w{k}").to_numpy() for k in range(_WORDS)], axis=1).view(np.uint64)
        bands = np.stack(group.column("bands").to_pylist())
        _, joined = np.unique(np.array([c.hex() for c in group.column("component").to_pylist()]), return_inverse=True)
        owner, hashes, tf = distinct_shingles(text_bytes(group))
        weights = tf * exact_weights(owner, hashes, _often(group, "often"), n_rows)
        cut = np.searchsorted(owner, np.arange(len(block) + 1))
        bag = [(hashes[i:j], weights[i:j], weights[i:j].sum()) for i, j in zip(cut, cut[1:], strict=False)]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for q in range(0, len(block), 256):
            alike = np.full((len(block[q:q + 256]), len(block)), HASHES, np.int16)
            for k in range(_WORDS):
                x = sig[q:q + 256, k][:, None] ^ sig[:, k][None, :]
                x = (((x & np.uint64(_LOW)) + np.uint64(_LOW)) | x) & np.uint64(_HIGH)
                alike -= np.bitwise_count(x)
            a, b = np.nonzero(alike >= least)
            n = alike[a, b]
            a = a + q
            use = (joined[a] != joined[b]) & ((a < b) if low == high else (block[a] == low) & (block[b] == high))
            found.append((a[use], b[use], n[use]))
        a, b, n = (np.concatenate(x) for x in zip(*found, strict=True))
        if band:
            new = ~(bands[a, :band] == bands[b, :band]).any(axis=1)
            a, b, n = a[new], b[new], n[new]
        links = []
        for k in np.argsort(-n, kind="stable"):
            i, j = a[k], b[k]
            if joined[i] != joined[j]:
                _, x, y = np.intersect1d(bag[i][0], bag[j][0], assume_unique=True, return_indices=True)
                common = np.minimum(bag[i][1][x], bag[j][1][y]).sum()
                if common >= THRESHOLD * (bag[i][2] + bag[j][2] - common) * (1 - 1e-12):
                    links.append((i, j))
                    joined[joined == joined[j]] = joined[i]
        key = group.column("key")
        return pa.table({"a": key.take(pa.array([x[0] for x in links], pa.int64())), "b": key.take(pa.array([x[1] for x in links], pa.int64()))})

    blocked = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = blocked.select("band", "value", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                           "block", "key", "component", "sig.*", "bands", "text", "often")
    return units.groupBy("band", "value", "low", "high").applyInArrow(compare, "a binary, b binary")


def op6_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))
