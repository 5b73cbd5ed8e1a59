"""Sharding, importance resampling and hard negatives, against plain versions."""

from __future__ import annotations

import bisect
import hashlib
import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordercraft.llm import components as connected, hardneg, resample, sharding
from tests.llm.helpers import components, corpus, documents, no_documents, words


def ring_by_brute_force(rows: list[tuple], shards: int, vnodes: int) -> list[tuple]:
    """Documents one by one, in turns: each waiting document asks the next shard clockwise that is not full."""
    digits = sharding.KEY_DIGITS
    place = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:digits], 16)
    points = sorted((place(f"{s}/{v}"), s) for s in range(shards) for v in range(vnodes))
    at = [p for p, _ in points]
    waiting = []
    for doc_id, text in rows:
        body = (text or "").encode()
        p = place("" if doc_id is None else str(doc_id))
        arc = bisect.bisect_left(at, p) % len(at)
        key = (arc, p <= at[-1], p, (doc_id is not None, doc_id or 0), len(body) + 1, crc32(body))
        waiting.append((key, doc_id, points[arc][1]))
    waiting.sort()
    room = {s: len(rows) // shards + (s < len(rows) % shards) for s in range(shards)}
    used, out = Counter(), []
    while waiting:
        full = {s for s in room if used[s] >= room[s]}
        asks = [(next(s for _, s in (points[arc % len(at)] for arc in range(w[0][0], w[0][0] + len(at))) if s not in full), w) for w in waiting]
        waiting = []
        for s, w in asks:
            if used[s] < room[s]:
                out.append((w[1], w[0][4], w[0][5], w[2], s, used[s]))
                used[s] += 1
            else:
                waiting.append(w)
    return out


def _placed(df) -> list[tuple]:
    return sorted(((r["doc_id"], r["size"], r["text_crc32"], r["home_shard"], r["shard"], r["slot"]) for r in df.collect()), key=str)


def test_op11_is_the_ring_filled_in_turns(spark):
    rows = [(r[0], r[1]) for r in corpus()]
    docs = documents(spark).withColumns({"shard": F.lit("mine"), "slot": F.lit("mine")})
    for shards, vnodes in ((8, 16), (5, 1), (1, 4), (60, 2)):
        got = sharding.shard_documents(docs, shards, vnodes)
        assert _placed(got) == sorted(ring_by_brute_force(rows, shards, vnodes), key=str)
    assert "text" not in got.columns and "key" in got.columns
    texts = sharding.shard_documents(docs, 8, 16, with_text=True)
    assert sorted(map(str, (r["text"] for r in texts.collect()))) == sorted(str(r[1]) for r in rows)


def test_op11_balance_slots_and_hot_keys(spark):
    many = spark.range(3000).selectExpr(
        "case when id % 3 > 0 then id end as doc_id", "case when id % 3 = 0 then 'same' else repeat('x', cast(id as int)) end as text")
    got = sharding.shard_documents(many, 7).groupBy("shard").agg(
        F.count("*").alias("n"), F.min("slot").alias("low"), F.max("slot").alias("high"), F.countDistinct("slot").alias("d")).collect()
    assert len(got) == 7 and all(r["low"] == 0 and r["high"] == r["n"] - 1 == r["d"] - 1 for r in got)
    assert max(r["n"] for r in got) - min(r["n"] for r in got) <= 1
    assert sharding.shard_documents(no_documents(spark)).count() == 0


def test_op11_another_shard_moves_little(spark):
    many = spark.range(4000).selectExpr("id as doc_id", "'t' as text")
    before = {r["doc_id"]: r["shard"] for r in sharding.shard_documents(many, 8).collect()}
    after = {r["doc_id"]: r["shard"] for r in sharding.shard_documents(many, 9).collect()}
    moved = sum(before[d] != after[d] for d in before) / len(before)
    assert 1 / 9 - 0.01 < moved < 0.25  # all documents would move by a modulus (8/9)


# -- op12 -----------------------------------------------------------------------------------


def resampled_by_brute_force(rows: list[tuple], target: list, share: int, least: int, buckets: int, seed: int) -> list[tuple]:
    def cells(text):
        w = words(text)
        return len(w), [crc32(f.encode()) % buckets for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(cells(text)[1])
    for text in target:
        t.update(cells(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in rows:
        n, cs = cells(text)
        weight = sum(gain[c] for c in cs) // len(cs) if cs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, n, len(cs), weight, score, None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[:len(able) * share // 100]):
        r[5] = i + 1
    return sorted(map(tuple, out), key=str)


def test_op12_matches_a_plain_version(spark):
    rows = [(r[0], r[1]) for r in corpus()] + [(None, corpus()[5][1]), (-4, "Ünï code WORDS über alles " * 8)]
    docs = spark.createDataFrame([(*r, "u", 1) for r in rows], "doc_id long, text string, rank string, n_words int")
    target = [corpus()[2][1], None, "", "One passage of words"]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    for share, least, buckets in ((25, 20, 10_000), (90, 1, 50), (100, 0, 1000)):
        got = resample.resample(docs, bench, share, least, buckets, 7)
        fields = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
        plain = sorted((tuple(r[f] for f in fields) for r in got.collect()), key=str)
        assert plain == resampled_by_brute_force(rows, target, share, least, buckets, 7)


def test_op12_empty_tables_and_other_ids(spark):
    bench = spark.createDataFrame([("a b",)], "text string")
    assert resample.resample(no_documents(spark), bench).count() == 0
    one = spark.createDataFrame([(1, "w " * 30)] * 8, "doc_id int, text string")
    got = resample.resample(one, bench.limit(0)).collect()  # repeated rows: two of eight are drawn
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2] and len(got) == 8
    with pytest.raises(TypeError):
        resample.resample(spark.createDataFrame([("a", "w")], "doc_id string, text string"), bench)


def test_op12_cutoff_counts_exactly(spark):
    rng = random.Random(3)
    for values in ([rng.randint(-90_000, 90_000) for _ in range(400)], [5] * 30 + [7] * 3, [-(1 << 63), (1 << 63) - 1, 0, 0]):
        rows = spark.createDataFrame([(v,) for v in values], "v long")
        for k in {1, 2, len(values) // 2, len(values)}:
            want = sorted(values)[-k]
            assert resample.cutoff(rows, "v", k) == (want, sum(v > want for v in values))


def test_op12_features_of_long_and_odd_texts():
    assert resample.feature_buckets(b"")[0] == 0
    n, cells = resample.feature_buckets(b"x" * 3_000_000 + b" y")
    assert n == 2 and list(cells) == [crc32(f) % 10_000 for f in (b"x" * 3_000_000, b"y", b"x" * 3_000_000 + b" y")]


# -- op13 -----------------------------------------------------------------------------------


def mined_by_brute_force(rows: list[tuple]) -> list[tuple]:
    live = []
    for n, (vec_id, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        live.append((n, vec_id, [math.floor(256 * np.float64(x)) for x in vector], label))
    out = []
    for n, vec_id, vector, label in live:
        if vec_id is None or vec_id % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), i is None, i or 0, m, lab) for m, i, v, lab in live)
        ids = lambda r: None if r[1] else r[2]
        for p in [r for r in scored if r[4] == label and ids(r) != vec_id][:5]:
            fit = [r for r in scored if r[4] != label and 50 * -p[0] <= 100 * -r[0] <= 95 * -p[0]][:3]
            out += [(vec_id, ids(p), k + 1, ids(r), -p[0], -r[0]) for k, r in enumerate(fit)]
    return sorted(out, key=str)


def vectors(n: int, dim: int, seed: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, dim))
    out = [(i, (centres[i % 4] + rng.standard_normal(dim) * 0.6).astype(np.float32).tolist(), i % 5) for i in range(n)]
    out += [(n + 50, out[3][1], 3), (n + 51, out[3][1], None), (n + 52, None, 2), (n + 53, [], 1), (n + 54, out[0][1][:2], 0)]
    for bad in (None, math.nan, math.inf, -math.inf):
        out.append((n + 100, [bad] + out[1][1][1:], 1))
    out += [out[0], out[50], out[7]]  # repeated rows, anchors among them
    out += [(None, out[2][1], 2), (None, out[2][1], 3), (-50, out[9][1], 4), (50_000, [0.0] * dim, 1)]
    return out


VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize(("dim", "least"), [(64, 4096), (7, 16), (100, 32)])
def test_op13_matches_a_plain_version(spark, monkeypatch, dim, least):
    monkeypatch.setattr(hardneg, "LEAST_BLOCK_ROWS", least)
    rows = vectors(230, dim, dim)
    table = spark.createDataFrame([(*r, "x") for r in rows], VECTORS + ", row string").repartition(3)
    got = sorted((tuple(r) for r in hardneg.mine(table).collect()), key=str)
    want = mined_by_brute_force(rows)
    assert len(want) > 20 and got == want


def test_op13_small_blocks_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "BLOCK_BYTES", 5000)
    rows = vectors(120, 16, 1)
    got = sorted((tuple(r) for r in hardneg.mine(spark.createDataFrame(rows, VECTORS)).collect()), key=str)
    assert got == mined_by_brute_force(rows)


def test_op13_empty(spark):
    assert hardneg.mine(spark.createDataFrame([], VECTORS)).count() == 0
    assert hardneg.mine(spark.createDataFrame([(50, None, 1), (0, [1.0], None)], VECTORS)).count() == 0


def test_op13_intervals_hold_every_score():
    rng = np.random.default_rng(5)
    for dim in (1, 3, 64, 130):
        turns = hardneg.rotations(dim)
        rows, anchors = (np.floor(rng.standard_normal((n, dim)) * 256).astype(np.int64) for n in (200, 12))
        rows[:3], anchors[0], rows[3:6] = 0, 0, anchors[1:4]
        exact = anchors @ rows.T
        _, low, high = hardneg.intervals(anchors, turns, hardneg.Codes(rows, turns))
        assert (low <= exact).all() and (exact <= high).all()
        if dim >= 64:  # and are narrow: a quarter of the product of lengths, either way
            norms = np.sqrt((anchors**2).sum(axis=1))[:, None] * np.sqrt((rows**2).sum(axis=1))
            assert (high - low <= 0.5 * norms + 1e-3).mean() > 0.95


@pytest.mark.parametrize("chunk", [200_000, 40])
def test_components_by_forests_and_stars(spark, monkeypatch, chunk):
    """A random graph, a long path and repeated edges, in one task and in many."""
    monkeypatch.setattr(connected, "CHUNK", chunk)
    rng = random.Random(chunk)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1060)] + [(3, 3), (7, 8), (7, 8)]
    got = connected.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = components({x for e in edges for x in e}, edges)
    assert {r["id"]: r["component"] for r in got} == {k: v for k, v in want.items() if k != v} and len(got) == len({r["id"] for r in got})
    assert connected.connected_components(spark.createDataFrame([], "a binary, b binary")).count() == 0
