"""A small corpus with every awkward case, and plain versions of the operators' definitions."""

from __future__ import annotations

import random
import re
from collections import Counter

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, key string, score string"
SYLLABLES = {"en": ["th", "er", "ing", "tion", "and", "ou"], "fr": ["eau", "é", "que", "oi", "ment", "è"]}


def words(text: str | None) -> list[str]:
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text)) if text is not None else []


def prose(rng: random.Random, n: int, lang: str = "en", line: int = 12) -> str:
    out = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(2, 5))) for _ in range(n)]
    return "\n".join(" ".join(out[i:i + line]) for i in range(0, n, line))


def corpus(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    texts: list[tuple] = []
    for n in range(24):
        lang = "fr" if n % 3 == 0 else "en"
        texts.append((prose(rng, rng.randint(40, 160), lang), lang))
    base = texts[1][0]
    for n in range(4):  # near copies: a word changed at the end, or one put in front
        texts.append((base + f" extra{n}", "en"))
    texts.append((texts[2][0].replace("\n", " x\n", 1), "en"))
    passage = prose(rng, 70, line=1000)
    for n in range(3):  # a long passage that several documents share
        texts.append((f"{prose(rng, 30)}\n{passage} {prose(rng, 20, line=1000)}", "en"))
    texts += [(texts[3][0], "fr")] * 3  # exact copies
    texts += [(None, "en"), ("", None), ("   \n\n", "en"), ("123 456 !!", "fr"), ("short one", "en"), ("aaaa" * 200, None),
              ("line again\nline again\nother words of a line", "en"), (prose(rng, 6000), "en")]
    rows = [(i, t, lang, None if i % 7 == 0 else f"src{i % 4}", len(t or ""), "S", "K", "C") for i, (t, lang) in enumerate(texts)]
    rows.append((None, texts[5][0], None, None, 0, None, None, None))
    rows.append(rows[8])  # a repeated row
    return rows


def documents(spark, seed: int = 1):
    return spark.createDataFrame(corpus(seed), SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text: str) -> Counter:
    w = words(text)
    return Counter([tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else [])


def components(ids, links) -> dict:
    """Smallest id that each id reaches."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
