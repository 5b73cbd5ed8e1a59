"""Operators on documents against plain versions of their definitions, on a corpus of awkward cases."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from ordercraft.llm import decontam, langid, linededup, minhash, mixing, repeats
from ordercraft.llm.words import count_words
from tests.llm.helpers import components, corpus, documents, no_documents, prose, shingles, words


def by_id(rows, column="doc_id"):
    out = defaultdict(list)
    for r in rows:
        out[r[column]].append(tuple(v for c, v in r.asDict().items() if c != column))
    return out


# -- op1 -----------------------------------------------------------------------------------

def items_of(seed=1):
    rows = corpus(seed)
    long = words(rows[4][1])
    return [(1, " ".join(long[5:30])), (2, " ".join(long[8:15])), (3, "Short ONE"), (4, "nothing of the kind here"), (5, None),
            (6, ""), (11, " ".join(long[5:30])), (12, " ".join(words(rows[10][1])[3:13])), (None, "short one"), (1, " ".join(long[5:30])), (None, " ".join(words(rows[13][1])[2:20]))]


def test_op1_matches_brute_force(spark):
    bench = items_of()
    got = decontam.decontaminate(documents(spark), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert len(got) == len(corpus()) and {r["size"] for r in got} == {"S", None}
    windows = []
    for item, text in bench:
        w = words(text)
        n = min(10, len(w))
        if n:
            windows += [(item, n, w[i:i + n]) for i in range(len(w) - n + 1)]
    hits = 0
    for r in got:
        w = words(r["text"])
        covered, items = set(), set()
        for item, n, x in windows:
            for i in range(len(w) - n + 1):
                if w[i:i + n] == x:
                    covered.update(range(i, i + n))
                    items |= {str(item)} - {"None"}  # an item without an id counts for its words only
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (
            len(w), len(covered), len(items), digest, bool(covered))
        hits += bool(covered)
    assert hits >= 3 and any(r["contaminated"] and not r["n_items"] for r in got)


def test_op1_full_filters_small_batches_and_empty_tables(spark, monkeypatch):
    bench = spark.createDataFrame(items_of(), "item_id long, text string")
    cols = ["doc_id", "n_hit", "items_sha256"]
    one = sorted(map(str, decontam.decontaminate(documents(spark), bench).select(*cols).collect()))
    monkeypatch.setattr(decontam, "marked", lambda some, cells: np.ones(len(cells), bool))  # a table that lets everything through
    monkeypatch.setattr(decontam, "OUT_ROWS", 7)
    assert sorted(map(str, decontam.decontaminate(documents(spark), bench).select(*cols).collect())) == one
    assert decontam.decontaminate(no_documents(spark), bench).count() == 0
    assert decontam.decontaminate(documents(spark), bench.limit(0)).where("contaminated").count() == 0


def test_op1_long_texts_and_clashing_columns(spark):
    """A document and an item of a hundred thousand words, of which nine, then ten words in a row are shared."""
    rng = np.random.default_rng(3)
    draw = lambda p, n: [f"{p}{x}" for x in rng.integers(0, 10**9, n)]
    item, doc = draw("i", 100_000), draw("d", 100_000)
    doc[500:509], doc[70_000:70_010] = item[40:49], item[99_990:]
    docs = spark.createDataFrame([(1, " ".join(doc), "a", "b")], "doc_id long, text string, _doc string, _hit string")
    row = decontam.decontaminate(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).first()
    assert (row["n_words"], row["n_hit"], row["n_items"], row["_doc"], row["_hit"]) == (100_000, 10, 1, "a", "b")


def test_words_are_counted_like_the_pattern():
    texts = ["", "a", " a b ", "A-b_c", "é ü", "x" * 1000, "1 22 333", "\n\t", "a\x00b"] * 3
    assert count_words([t.encode() for t in texts]).tolist() == [len(words(t)) for t in texts]


def test_winnowing_guarantee():
    """Every span of ten words that two texts share has a fingerprint in common."""
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (40, 60))
        at, to = rng.integers(0, 31), rng.integers(0, 51)
        b[to:to + 10] = a[at:at + 10]
        found = [set(decontam.winnow(x, np.zeros(len(x), int))[1].tolist()) for x in (a, b)]
        assert found[0] & found[1]


# -- op3 -----------------------------------------------------------------------------------

def removed_by_brute_force(rows):
    first, lines = {}, []
    for doc, text, *_ in rows:
        if text is not None:
            for n, line in enumerate(text.split("\n")):
                w = frozenset(words(line))
                if w:
                    lines.append(((doc is not None, doc or 0, n), doc, n, w))
    for place, _, _, w in lines:
        first[w] = min(first.get(w, place), place)
    gone = set()
    for place, doc, n, w in lines:
        if any(other < place and 5 * len(w & x) >= 4 * len(w | x) for x, other in first.items() if w & x):
            gone.add((doc, n))
    return gone


@pytest.mark.parametrize("hot", [linededup.HOT, 1])
def test_op3_matches_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(linededup, "HOT", hot)
    got = {(r["doc_id"], r["line"]) for r in linededup.removed_lines(documents(spark)).collect()}
    want = removed_by_brute_force(corpus())
    assert got == want and len(want) > 20


def test_op3_in_small_blocks(spark, monkeypatch):
    """Groups larger than a block are finished in the second round."""
    monkeypatch.setattr(linededup, "BLOCK", 8)
    monkeypatch.setattr(linededup, "NEAR", 1)
    got = {(r["doc_id"], r["line"]) for r in linededup.removed_lines(documents(spark)).collect()}
    assert got == removed_by_brute_force(corpus())


@pytest.mark.parametrize("hot", [linededup.HOT, 1])
def test_op3_passes_on_rows_by_sets_not_by_pairs(spark, monkeypatch, hot):
    """Variants of one line, nearly all similar to each other; two documents share an id and NULL ids are one document."""
    monkeypatch.setattr(linededup, "HOT", hot)
    base = [f"word{n}" for n in range(30)]
    texts = [" ".join(base[:n % 30] + [f"other{n}"] + base[n % 30 + 1:]) for n in range(90)]
    texts += [" ".join(base), " ".join(base[:24]), " ".join(base[6:])]
    rows = [(n // 2 if n > 5 else None, t) for n, t in enumerate(texts)]
    written = {}

    def counted(df, label, write=linededup.materialize):
        out = write(df, label)
        written[label] = max(written.get(label, 0), out.count())
        return out

    monkeypatch.setattr(linededup, "materialize", counted)
    got = {(r["doc_id"], r["line"]) for r in linededup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == removed_by_brute_force(rows) and len(got) > 40
    assert max(written.values()) <= 2 * len(rows), written


def test_op3_pairs_of_lines_of_any_bitmap(spark):
    """Pairs of lines that differ by a few words, whose bitmaps differ in any bit."""
    rng = random.Random(3)
    rows = []
    for n in range(300):
        line = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(20, 80))]
        rows += [(2 * n, " ".join(line)), (2 * n + 1, " ".join(line[:-1] + [f"v{n}"]))]
    got = {(r["doc_id"], r["line"]) for r in linededup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(2 * n + 1, 0) for n in range(300)}




def test_word_hashes_of_long_texts_and_short_ones():
    from ordercraft.llm.words import SLICE_BYTES, word_hashes

    long = b"Ab c " * (SLICE_BYTES // 2)
    hashes, owner = word_hashes([b"", b"ab", long, b" - ", b"c AB"])
    ab, c = hashes[0], hashes[2]
    assert ab != c and owner.tolist() == [1] + [2] * (len(long) // 5 * 2) + [4, 4]
    assert (hashes[1:-2:2] == ab).all() and (hashes[2:-2:2] == c).all() and hashes[-2:].tolist() == [c, ab]
    assert word_hashes([b"", b"--"])[0].size == 0


def test_op3_columns_and_texts(spark):
    from pyspark.sql import functions as F

    out = linededup.dedup_lines(documents(spark)).withColumn(
        "left", linededup.without_removed(F.col("text"), F.col("removed"))).collect()
    assert len(out) == len(corpus())
    for r in out:
        lines = r["text"].split("\n") if r["text"] is not None else []
        assert r["n_lines"] == len(lines)
        if r["text"] is None:
            assert r["left"] is None
        else:
            kept = [x for n, x in enumerate(lines) if n not in set(r["removed"])]
            assert r["left"] == ("\n".join(kept) if kept else "")
    assert linededup.dedup_lines(no_documents(spark)).count() == 0


# -- op5 -----------------------------------------------------------------------------------

def test_op5_totals_and_bounds(spark):
    out = mixing.mix_sources(documents(spark)).collect()
    assert len(out) == len(corpus())
    taken, size, target = Counter(), Counter(), {}
    for r in out:
        n = len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", r["text"] or "") if w])
        assert r["size"] == n and 0 <= r["taken"] <= 2 * n
        taken[r["source"]] += r["taken"]
        size[r["source"]] += n
        target[r["source"]] = r["target"]
    total = sum(size.values())
    assert sum(target.values()) == pytest.approx(1.5 * total)
    for source, value in target.items():
        assert taken[source] == math.floor(value) and value <= 2 * size[source]
    order = sorted(s for s in size if s is not None) + [None]
    weight = {s: [3, 1, 2][i % 3] for i, s in enumerate(order)}
    free = {target[s] / weight[s] for s in order if target[s] < 2 * size[s]}
    assert max(free) == pytest.approx(min(free))
    again = mixing.mix_sources(documents(spark).repartition(7)).select("doc_id", "size", "taken").collect()
    assert sorted(map(str, again)) == sorted(str(x) for x in mixing.mix_sources(documents(spark)).select(
        "doc_id", "size", "taken").collect())


def test_op5_empty_tables_and_no_words(spark):
    assert mixing.mix_sources(no_documents(spark)).count() == 0
    nothing = spark.createDataFrame([(1, None, "a"), (2, "", None), (2, " ", "b")], "doc_id long, text string, source string")
    assert {(r["target"], r["taken"]) for r in mixing.mix_sources(nothing).collect()} == {(0.0, 0)}


# -- op6 -----------------------------------------------------------------------------------

def weighted_similarity(a: Counter, b: Counter, idf) -> float:
    low = sum(min(a[s], b[s]) * idf[s] for s in a.keys() & b.keys())
    total = sum(n * idf[s] for x in (a, b) for s, n in x.items())
    return low / (total - low) if total else 0.0


def test_op6_matches_brute_force(spark):
    rows = corpus()
    got = by_id(minhash.near_duplicates(documents(spark)).collect())
    present = [(d, t) for d, t, *_ in rows if t is not None]
    bags = {t: shingles(t) for _, t in present}
    frequency = Counter(s for _, t in present for s in bags[t])
    n = len(present)
    idf = {s: 1 + minhash.IDF_WEIGHT * math.log(n / f) / math.log(n) for s, f in frequency.items()}
    texts = list(bags)
    links = [(i, j) for j in range(len(texts)) for i in range(j)
             if weighted_similarity(bags[texts[i]], bags[texts[j]], idf) >= minhash.THRESHOLD]
    group = components(range(len(texts)), links)
    smallest = defaultdict(list)
    for d, t in present:
        if d is not None:
            smallest[group[texts.index(t)]].append(d)
    assert links
    for d, t, *_ in rows:
        want = d if t is None else min(smallest[group[texts.index(t)]], default=None)
        assert set(got[d]) == {(want,)}, (d, got[d], want)
    assert sum(map(len, got.values())) == len(rows)
    assert minhash.near_duplicates(no_documents(spark)).count() == 0


def test_op6_verifies_by_exact_frequencies(spark, monkeypatch):
    full = np.full(1 << minhash.FREQUENCY_BITS, 1 << 20, np.uint32)
    monkeypatch.setattr(minhash, "frequency_table", lambda texts: full)  # full cells: all weights are 1
    rng = random.Random(5)
    common, rare, filler = prose(rng, 88), prose(rng, 82), lambda n: prose(rng, n)
    often = prose(rng, 14)
    texts = [f"{common} {filler(10)}", f"{common} {filler(10)}", f"{rare} {often}", f"{rare} {filler(6)}"]
    texts += [f"{common} {filler(150)} {often}" for _ in range(56)]
    bags = [shingles(t) for t in texts]
    frequency = Counter(s for b in bags for s in b)
    idf = {s: 1 + minhash.IDF_WEIGHT * math.log(len(texts) / f) / math.log(len(texts)) for s, f in frequency.items()}
    flat = dict.fromkeys(idf, 1.0)
    # one pair is a link by full cells alone, the other by exact frequencies alone
    assert weighted_similarity(bags[0], bags[1], flat) > minhash.THRESHOLD > weighted_similarity(bags[0], bags[1], idf)
    assert weighted_similarity(bags[2], bags[3], flat) < minhash.THRESHOLD < weighted_similarity(bags[2], bags[3], idf)
    links = [(i, j) for j in range(len(texts)) for i in range(j) if weighted_similarity(bags[i], bags[j], idf) >= minhash.THRESHOLD]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == components(range(len(texts)), links)


@pytest.mark.parametrize(("rows", "size"), [(8, 1 << 20), (4096, 3000)])
def test_op6_buckets_of_many_blocks(spark, monkeypatch, rows, size):
    """A group of variants around the threshold, in buckets of several blocks by rows or by bytes, one text far longer."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", rows)
    monkeypatch.setattr(minhash, "BLOCK_BYTES", size)
    rng = random.Random(rows)
    base = prose(rng, 120, line=1000).split()
    texts = []
    for n in range(70):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 2, 3, 4])):
            copy[rng.randrange(len(copy))] = f"edit{n}x{rng.randrange(9)}"
        texts.append(" ".join(copy))
    texts.append(" ".join(base * 40))
    bags = [shingles(t) for t in texts]
    frequency = Counter(s for b in bags for s in b)
    idf = {s: 1 + minhash.IDF_WEIGHT * math.log(len(texts) / f) / math.log(len(texts)) for s, f in frequency.items()}
    links = [(i, j) for j in range(len(texts)) for i in range(j) if weighted_similarity(bags[i], bags[j], idf) >= minhash.THRESHOLD]
    want = components(range(len(texts)), links)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    # Bands find a link at the threshold with probability 0.995, so a class may be missed, but none may be made up.
    assert all(want[d] == want[c] for d, c in got.items())
    assert sum(got[d] != want[d] for d in got) <= 2 and len(set(want.values())) > 3


def test_op6_draws_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    sampler = minhash.Sampler(np.exp(rng.normal(size=1 << minhash.FREQUENCY_BITS)), hashes=2000)
    a = [f"a{n}" for n in range(40)]
    b = a[:25] + [f"b{n}" for n in range(20)]
    owner, hashes, weights = sampler.shingles([" ".join(a).encode(), " ".join(b).encode()])
    one, two = ({h: w for o, h, w in zip(owner, hashes, weights) if o == k} for k in (0, 1))
    low = sum(min(one[h], two[h]) for h in one.keys() & two.keys())
    _, draws = sampler.signatures(owner, hashes, weights)
    true = low / (sum(one.values()) + sum(two.values()) - low)
    assert (draws[0] == draws[1]).mean() == pytest.approx(true, abs=0.04)


# -- op7 -----------------------------------------------------------------------------------

def kept_by_brute_force(texts):
    starts = Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for t in texts:
        hit = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if starts[t[i:i + 200]] > 1:
                hit[i:i + 200] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~hit])
        runs = int((np.diff(np.r_[0, hit.astype(int)]) == 1).sum())
        out.append((len(t), int(hit.sum()), runs, kept))
    return out


def test_op7_matches_brute_force(spark):
    rows = corpus()
    edge = "".join(chr(97 + (n * n) % 26) for n in range(200))
    extra = [(100, "x" * 400), (101, "ab" * 150 + "\n" + "é" * 300), (102, "1" + edge), (103, "2" + edge + "3"),
             (104, "4" + edge[:199]), (105, edge[::-1] + "y" + edge[::-1])]
    table = [(r[0], r[1]) for r in rows] + extra
    got = repeats.remove_repeats(spark.createDataFrame(table, "doc_id long, text string")).collect()
    want = kept_by_brute_force([(t or "").encode() for _, t in table])
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == sorted(
        (str(d), *w) for (d, _), w in zip(table, want))
    assert repeats.remove_repeats(no_documents(spark)).count() == 0


@pytest.mark.parametrize("name, value", [("PIECE", 500), ("CROWD", 3), ("HELD", 5)])
def test_op7_long_texts_and_large_groups(spark, monkeypatch, name, value):
    monkeypatch.setattr(repeats, name, value)
    rows = [(r[0], r[1]) for r in corpus(2)]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = kept_by_brute_force([(t or "").encode() for _, t in rows])
    assert sorted((str(r["doc_id"]), r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == sorted(
        (str(d), *w[1:]) for (d, _), w in zip(rows, want))


# -- op8 -----------------------------------------------------------------------------------

def test_op8_cases(spark):
    out = langid.predict_languages(documents(spark)).collect()
    assert len(out) == len(corpus())
    for r in out:
        letters = r["text"] is not None and any(map(str.isalpha, r["text"]))
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
        if letters and len(words(r["text"])) > 30:
            assert r["lang"] in (None, r["lang_pred"])
    assert langid.predict_languages(no_documents(spark)).count() == 0


def test_op8_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = langid.predict_languages(docs).where("held_out")
    assert out.count() > 20 and out.where("lang_pred = lang").count() / out.count() >= 0.95


def test_op8_mixture_proportions():
    """Two languages in known parts: both are in the set, and the larger part is the main language."""
    rng = np.random.default_rng(0)
    logp = np.log(rng.dirichlet(np.full(500, 0.1), size=3).T + 1e-9)
    p = np.exp(logp) / np.exp(logp).sum(axis=0)
    counts = rng.multinomial(3000, 0.7 * p[:, 0] + 0.3 * p[:, 2])
    lang, score = langid.infer(counts, np.log(p), 4.0)
    assert lang == 0 and score == pytest.approx(0.7, abs=0.05)
