"""Pages, embeddings, conversations and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import json
import tempfile
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ordercraft.llm import chat, embeddup, htmltext, mixing, warc, words as wordlib
from ordercraft.operators.ids import assign_dense_ids
from tests.llm.helpers import components, corpus, documents, no_documents
from tests.llm.test_text_operators import removed_by_brute_force

PAGES = [
    (1, "http://www.a.example/x?b=1", "<p>one</p>"), (2, "http://a.example/y", "<p>one</p>"), (3, "https://b.example:8080/", None),
    (4, "http://c.example/é", ""), (5, None, "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n\tx"), (6, "not a url\nwith\ttabs", "é" * 50_000),
    (7, "http://[bad/", "seven"), (7, "http://[bad/", "seven"), (None, "http://n.example/", "<p>one</p>"), (9, "http://a.example/y", "nine"),
    (10, "-", "ten"), (11, "\\N", "eleven")]
PAGE_SCHEMA = "page_id long, url string, html string"


def test_op4_round_trip(spark):
    pages = spark.createDataFrame([(*p, "extra") for p in PAGES], PAGE_SCHEMA + ", text string")
    archive = warc.archive_pages(pages, tempfile.mkdtemp(prefix="ordercraft-warc-") + "/a")
    got = warc.read_index(spark, archive).collect()
    assert len(got) == len(PAGES)
    payload = {}
    for page, _, html in PAGES:
        body = (html or "").encode()
        payload.setdefault(body, []).append(page)
    want = []
    for page, _, html in PAGES:
        body = (html or "").encode()
        newest = max(p for p in payload[body] if p is not None)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        same = page == newest
        want.append((page, len(body), digest, "response" if same else "revisit", None if same else newest))
    fields = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(str, (tuple(r[f] for f in fields) for r in got))) == sorted(map(str, want))
    for page, url, html in PAGES:  # look-ups by binary search and range reads
        if url is not None and not set(url) & set("\t\r\n"):
            found = warc.lookup(spark, archive, url)
            mine = [body for head, body in found if head["WARC-Record-ID"] == f"<urn:page:{page if page is not None else '-'}>"]
            revisit = next(w for w in want if w[0] == page)[3] == "revisit"
            assert mine and bytes(mine[0]) == (b"" if revisit else (html or "").encode())
    assert warc.lookup(spark, archive, "http://unknown.example/") == []


@pytest.mark.parametrize("groups", [1, 3, 4096])
def test_op4_look_up_of_many_urls(spark, monkeypatch, groups):
    """URLs with captures over several blocks, single ones, absent ones, repeated ones and NULL."""
    monkeypatch.setattr(warc, "GROUPS", groups)
    rows = [(i, f"http://h{i % 5}.example/{i // 3 if i % 2 else 'hot'}", f"body {i % 40}") for i in range(120)]
    rows += [(200 + i, "http://www.hot.example/", f"hot {i}") for i in range(40)] + PAGES[:12]
    pages = spark.createDataFrame(rows, PAGE_SCHEMA)
    archive = warc.write_archive(pages, tempfile.mkdtemp(prefix="ordercraft-warc-") + "/a")
    warc.write_index(warc.read_archive(spark, archive), archive, lines=7)
    whole = sorted(map(str, (r.asDict() for r in warc.read_index(spark, archive).collect())))
    got = sorted(map(str, (r.asDict() for r in warc.lookup_urls(spark, archive, pages.select("url")).collect())))
    assert got == whole and len(got) == len(rows)
    some = ["http://www.hot.example/", "http://h1.example/2", "http://h1.example/2", "http://hot.example/", "http://none.example/", None]
    asked = spark.createDataFrame([(u,) for u in some], "url string")
    found = sorted((str(r["url"]), r["page_id"]) for r in warc.lookup_urls(spark, archive, asked).collect())
    assert found == sorted((str(u), p) for p, u, _ in rows if u in some)
    assert warc.lookup_urls(spark, archive, asked.limit(0)).count() == 0


def test_op4_empty_archive(spark):
    none = spark.createDataFrame([], PAGE_SCHEMA)
    assert warc.lookup_urls(spark, warc.archive_pages(none), none.select("url")).count() == 0


def test_op4_min_bytes_and_blocks(spark):
    pages = spark.createDataFrame(PAGES, PAGE_SCHEMA)
    types = {r["page_id"]: r["record_type"] for r in warc.mark_records(pages, min_bytes=11).collect()}
    assert set(types.values()) == {"response"}
    many = spark.range(50).selectExpr("id as page_id", "concat('http://h', id % 7, '.example/', id) as url", "cast(id as string) as html")
    archive = warc.write_archive(many, tempfile.mkdtemp(prefix="ordercraft-warc-") + "/a")
    warc.write_index(warc.read_archive(spark, archive), archive, lines=4)
    directory = spark.read.parquet(archive.directory).orderBy("block_id").collect()
    assert [r["first"] for r in directory] == sorted(r["first"] for r in directory) and sum(r["lines"] for r in directory) == 50
    assert all(a["last"] <= b["first"] for a, b in zip(directory, directory[1:]))
    for n in (0, 13, 49):
        (head, body), = warc.lookup(spark, archive, f"http://h{n % 7}.example/{n}")
        assert bytes(body) == str(n).encode()
    assert warc.read_index(spark, warc.archive_pages(pages.limit(0), tempfile.mkdtemp(prefix="ordercraft-warc-") + "/a")).count() == 0


ARTICLE = "<p>" + "The first paragraph of the article, with commas, and some length to it. " * 3 + "</p>"


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("   ", ""), ("<script>var a = '<p>x</p>';</script>", ""), ("plain &amp; simple", "plain & simple"),
    ("<p>a<b>b</b>c<br>d&nbsp;e</p><p>f", "abc d e f"), ("<!-- <p>no</p> --><p>yes</p>", "yes"), ("<div>a<p></p>c</div>", "a c"),
    (f"<nav><ul><li><a>Home</a></ul></nav><div id=main>{ARTICLE}<p>Short.</p></div><div class='sidebar'><p>By the way, there is, "
     "you know, much more to read, here and there.</p></div>", "{A} Short."),
    (f"<header><h1>Site</h1></header><main><h1>Title</h1>{ARTICLE}<form><p>Your name, please, and your address, too.</p></form>"
     "<ul class=menu><li>x</ul></main><footer>(c)</footer>", "Title {A}"),
    (f"<body><div class=post><h2>T</h2>{ARTICLE}</div><div id=comments><p>Great, really, truly, a very good read, thank you.</p></div>"
     "<div class='cookie-notice'>We use cookies, as you know, and so on, and on.</div></body>", "T {A}"),
    (f"<article>{ARTICLE}<section><p>One.</p></section><section><p>Two.</p></section></article>", "{A} One. Two."),
    (f"<div>{ARTICLE}<ul><li><a>a link</a><li><a>another</a><li><a>a third</a></ul></div>", "{A}"),
    ("<p title='a>b'>quoted</p><p class=\"x>unclosed", "quoted unclosed"),  # a tag with an open quote ends at its first >
])
def test_op2_main_text(html, text):
    article = " ".join(ARTICLE[3:-4].split())
    assert htmltext.main_text(html) == text.replace("{A}", article)


def test_op2_table(spark):
    pages = spark.createDataFrame([(*p, "old") for p in PAGES], PAGE_SCHEMA + ", text string")
    out = htmltext.extract_pages(pages).collect()
    assert len(out) == len(PAGES) and all(r["n_chars"] == len(r["text"]) for r in out)
    assert {r["page_id"]: r["text"] for r in out}[6] == "é" * 50_000
    assert htmltext.extract_pages(pages.limit(0)).count() == 0


PROSE = "A long paragraph of the article, with commas, and enough words to be taken for prose by any rule, as it goes on. "


@pytest.mark.parametrize("page", [
    "<body><div class='content has-sidebar'><p>{0}</p><p>{0}</p></div></body>",
    "<body class='comments-open'><article class='post comments-open'><p>{0}</p><p>{0}</p></article></body>",
    "<body class='no-sidebar'><div class='elementor-widget x'><p>{0}</p><p>{0}</p></div></body>",
    "<body><form id='aspnetForm'><div><p>{0}</p><p>{0}</p></div></form></body>",
    "<body><article><p>{0}</p><section id='related-work'><p>{0}</p></section></article></body>"])
def test_op2_keeps_content_with_boilerplate_parts(page):
    page = page.format(PROSE * 3)
    assert htmltext.main_text(page) == " ".join([(PROSE * 3).strip()] * 2)


def test_op2_keeps_headings():
    text = (PROSE * 3).strip()
    assert htmltext.main_text(f"<body><h1>T</h1><div><p>{text}</p><p>{text}</p></div></body>") == f"T {text} {text}"
    assert htmltext.main_text(f"<article><div class='entry-header'><h1>T</h1></div><p>{text}</p></article>") == f"T {text}"
    assert htmltext.main_text(f"<body><form><p>Log in with your name, please</p></form><div><p>{text}</p><p>{text}</p></div></body>") == f"{text} {text}"


P = "A paragraph of prose in the article, with some words and a comma or two, so that it reads like any other one."


@pytest.mark.parametrize(("page", "text"), [
    # a stray quote inside a quoted value, and values without quotes or without an end
    (f"<body><article><p>Start <a title='it's here'>{P}</a></p><p>{P} Don't stop.</p></article></body>", f"Start {P} {P} Don't stop."),
    (f"<body><article><p title=it's>{P}</p><p class=\"x>{P}</p></article></body>", f"{P} {P}"),
    (f"<body><article><p data-x='a > b'>{P}</p><p>{P}</p></article></body>", f"{P} {P}"),
    # an article in sibling containers without article or main
    (f"<div><div>A {P} {P}</div><div><h2>B</h2><p>{P}</p></div></div>", f"A {P} {P} B {P}"),
    (f"<body><div><p>{P}</p><p>{P}</p></div><blockquote>Said.</blockquote><ul><li>One</li><li>Two</li></ul><p>The end.</p></body>",
     f"{P} {P} Said. One Two The end."),
    (f"<body><main><article><p>{P}</p></article><article><p>{P} Again.</p></article></main></body>", f"{P} {P} Again."),
    (f"<body><article><p>{P}</p></article><article><p>{P} Again.</p></article></body>", f"{P} {P} Again."),
    (f"<body><div class=hd><h1>Title</h1></div><div><p>{P}</p><p>{P}</p></div></body>", f"Title {P} {P}"),
    (f"<body><article><p>{P}</p><ul><li><a href=1>First work</a><li><a href=2>Second work</a><li><a href=3>Third work</a></ul></article></body>",
     f"{P} First work Second work Third work"),
    (f"<body><div class='search'><p>{P}</p><p>{P}</p></div></body>", f"{P} {P}"),
    # readers' comments, also when they are longer than the article, and notices inside it
    (f"<body><article><p>{P}</p><p>{P}</p><div class='comment-list'><p>{P} I like it!</p></div></article></body>", f"{P} {P}"),
    (f"<body><div><p>{P}</p><p>{P}</p></div><div id='reader-comments'><p>{P}</p><p>{P}</p><p>{P}</p><p>{P}</p></div></body>", f"{P} {P}"),
    (f"<body><article><div class='cookie-banner'><p>{P} Accept?</p></div><p>{P}</p><p>{P}</p></article></body>", f"{P} {P}"),
    (f"<body><article><p>{P}</p><div class=notice>{P}</div><p>{P}</p></article></body>", f"{P} {P}"),
    (f"<body><ul><li><a>Home</a><li><a>News</a><li><a>About</a></ul><div><p>{P}</p><p>{P}</p></div></body>", f"{P} {P}")])
def test_op2_parts_of_articles_and_of_pages(page, text):
    assert htmltext.main_text(page) == text


def test_op2_generated_pages():
    """Articles in several layouts amid menus, adverts, forms, comments and footers: the article alone comes out."""
    rng = np.random.default_rng(7)
    sentence = lambda: " ".join("".join(rng.choice(list("abcdeiou"), rng.integers(2, 9))) for _ in range(rng.integers(14, 40))) + ", so."
    around = ["<nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>", "<div class='ad-slot'>{}</div>",
              "<aside><p>{}</p></aside>", "<form class='signup'><p>{}</p><input></form>", "<div id='cookie-consent'><p>{}</p></div>",
              "<footer>&copy; {}</footer>", "<script>var x = '<p>{}</p>';</script>", "<div class='share-bar'><a>Post</a> <a>Send</a></div>",
              "<section class='comments'><h3>2 comments</h3><p>{}</p></section>", "<!-- <p>{}</p> -->"]
    layouts = ["<article>{}</article>", "<main><article>{}</article></main>", "<div id=content>{}</div>", "<div><div class=body>{}</div></div>",
               "<main><section>{}</section></main>"]
    for n in range(200):
        head, paragraphs = f"Title {n}", [sentence() for _ in range(rng.integers(2, 7))]
        body = f"<h1>{head}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
        noise = [x.replace("{}", sentence()) for x in rng.permutation(around)[:rng.integers(2, 8)]]
        at = rng.integers(0, len(noise) + 1)
        page = "<html><head><title>no</title></head><body>" + "".join(noise[:at]) + layouts[n % len(layouts)].format(body) + "".join(noise[at:]) + "</body></html>"
        assert htmltext.main_text(page) == " ".join([head, *paragraphs]), page


@pytest.mark.parametrize("part", ["<div><p>", "<div>", "</section>", "<section></div>", "<b>x", "<ul><li>", "<article>"])
def test_op2_time_is_linear_in_depth(part):
    def seconds(n):
        start = time.process_time()
        htmltext.main_text(f"<body><article><p>{P}</p>" + (part + " some words, of prose ") * n)
        return time.process_time() - start

    seconds(100)
    assert seconds(16_000) < 6 * max(seconds(4_000), 0.1)


def vectors(n=300, dim=16, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.normal(size=dim) if i % 3 or not rows else np.array(rows[rng.integers(len(rows))][1]) + rng.normal(size=dim) * 0.2
        rows.append((i, [float(np.float32(x)) for x in v]))
    hot = rng.normal(size=dim)
    rows += [(n + i, [float(x) for x in hot + rng.normal(size=dim) * 0.05]) for i in range(60)]
    rows += [(500 + i, rows[0][1]) for i in range(5)] + [rows[3]] * 2  # copies, repeated rows
    rows += [(600, None), (601, [0.0] * dim), (602, [float("nan")] * dim), (603, [float("inf")] + [1.0] * (dim - 1)),
             (604, [None] + [1.0] * (dim - 1)), (605, []), (606, [1.0, 2.0]), (607, [2.0, 4.0]), (None, rows[0][1]),
             (608, [x * 1e-300 for x in rows[1][1]])]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_op9_matches_brute_force(spark, monkeypatch, small):
    if small:  # many groups, and groups of several blocks
        monkeypatch.setattr(embeddup, "CELL_ROWS", 64)
        monkeypatch.setattr(embeddup, "BLOCK_ROWS", 40)
    rows = vectors()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddup.dedup_embeddings(
        spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, id int")).collect()}
    distinct = {i: v for i, v in rows}
    unit = {}
    for i, v in distinct.items():
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            x = np.array(v) / np.abs(v).max()
            unit[i] = x / np.linalg.norm(x)
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    group, count = components(distinct, [x for x in links]) if None not in distinct else components(
        [i for i in distinct if i is not None], links), {}
    for a, b in links:
        count[a], count[b] = count.get(a, 0) + 1, count.get(b, 0) + 1
    assert got.pop(None) == (0, None, False)
    assert got == {i: (count.get(i, 0), group[i], group[i] == i) for i in group} and len(links) > 1000


def test_op9_repeated_rows_stay(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (3, None)]
    got = embeddup.dedup_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 1, True)] * 2 + [(2, 1, 1, False)] + [(3, 0, 3, True)] * 2


def test_op9_plan_and_empty(spark):
    bits, tables = embeddup.plan(10_000_000, 0.9)
    same = (1 - np.arccos(0.9) / np.pi) ** bits
    assert 1 - (1 - same) ** tables >= embeddup.RECALL and 2**bits * embeddup.CELL_ROWS >= 10_000_000
    assert embeddup.dedup_embeddings(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_op10_links_orders_and_checks(spark):
    calls = [("c", 1, "a", "search", '{"query": "x", "limit": 1.0}'), ("c", 3, "b", "search", '{ "limit":5,"query":"${a}" }'),
             ("c", 5, "d", "rank", '{"source":"${e}","query":"q","limit":300}'), ("c", 7, "e", "search", '{"limit":1,"query":"${b}","z":1}'),
             ("c", 9, "f", "search", "not json"), ("c", 9, None, "search", "{}"), ("c", 11, "g", "mystery", "{}"),
             ("c", 13, "h", "search", '{"query":"${k}","limit":1}'), ("c", 15, "k", "search", '{"query":"${h}","limit":1}'),
             ("c", 17, "m", "search", '{"query":"${none}","limit":1}'), ("c", 19, "n", "search", '{"query":"q","limit":2}'),
             ("c", 19, "n", "search", '{"query":"q","limit":2}'), (None, 1, "a", "search", '{"query":"q","limit":2}')]
    results = [("c", 2, "a", "done\n\"quoted\""), ("c", 4, "b", None), ("c", 1, "d", "too early"), ("c", 8, "zz", "orphan"),
               ("c", 20, "n", "two calls"), ("c", 8, "e", "1"), ("c", 8, "e", "1"), ("c", 3, None, "?")]
    frame = lambda rows, s: spark.createDataFrame(rows, s)
    messages = frame([("c", 0, "user", "hello"), ("c", 0, "user", None)], "conv_id string, turn int, role string, text string")
    call_frame = frame(calls, "conv_id string, turn int, call_id string, name string, arguments string")
    result_frame = frame(results, "conv_id string, turn int, call_id string, content string")
    out = chat.link_tools(messages, call_frame, result_frame, chat.SCHEMAS).collect()
    assert len(out) == len(messages.collect()) + len(calls) + len(results)
    call = {(r["conv_id"], r["call_id"]): r for r in out if r["kind"] == "call"}
    status = {k[1]: r["status"] for k, r in call.items() if k[0]}
    assert status == {"a": "invalid" if call["c", "a"]["errors"] else "ok", "b": "ok", "d": "invalid", "e": "invalid", "f": "invalid",
                      None: "no_id", "g": "invalid", "h": "cycle", "k": "cycle", "m": "bad_reference", "n": "duplicate_id"}
    assert call[None, "a"]["status"] == "no_id"
    depth = {k[1]: r["depth"] for k, r in call.items() if k[0]}
    assert depth["a"] < depth["b"] < depth["e"] < depth["d"] and depth["h"] is None and depth["k"] is None
    assert call["c", "d"]["errors"] == ["limit: above 200"] and call["c", "e"]["errors"] == ["unknown: z"]
    assert call["c", "f"]["errors"] == ["arguments: not a JSON object"] and call["c", "g"]["errors"] == ["unknown tool"]
    assert call["c", "b"]["json"] == '{"arguments":{"limit":5,"query":"${a}"},"id":"b","name":"search","role":"assistant"}'
    got = sorted((r["call_id"] or "", r["status"]) for r in out if r["kind"] == "result")
    assert got == [("", "no_id"), ("a", "ok"), ("b", "ok"), ("d", "early"), ("e", "duplicate_result"), ("e", "duplicate_result"),
                   ("n", "duplicate_id"), ("zz", "orphan")]
    for r in out:
        value = json.loads(r["json"])
        assert json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r["json"]
    empty = chat.link_tools(messages.limit(0), call_frame.limit(0), result_frame.limit(0), chat.SCHEMAS)
    assert empty.count() == 0


def depths_by_brute_force(edges) -> dict:
    needs: dict = {}
    for conv, call, other in edges:
        needs.setdefault((conv, call), set()).add((conv, other))
    depth, left = {}, dict(needs)
    while ready := [k for k, v in left.items() if all(o in depth or o not in needs for o in v)]:
        found = {k: 1 + max(depth.get(o, 0) for o in left[k]) for k in ready}
        depth.update(found)
        left = {k: v for k, v in left.items() if k not in found}
    return depth | dict.fromkeys(left)


def test_op10_depth_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    edges = {(conv, f"x{i}", f"x{rng.integers(0, i + (conv == 5))}")  # conversation 5 has cycles
             for conv in range(6) for i in range(1, 12) for _ in range(1 + (conv > 1 and rng.integers(0, 6) == 0))}
    edges |= {(7, "a", "a"), (8, "a", "b"), (8, "b", "a"), (8, "c", "b"), (8, "d", "c"), (8, "d", "root"), (8, "e", "root")}
    got = {(r["conv_id"], r["call_id"]): r["depth"] for r in chat.topological_depth(
        spark.createDataFrame(sorted(edges), "conv_id int, call_id string, needs string")).collect()}
    want = depths_by_brute_force(edges)
    assert got == want and None in want.values() and max(v or 0 for v in want.values()) > 3


def test_op10_long_chain_takes_few_rounds(spark, monkeypatch):
    written = []
    real = chat.materialize
    monkeypatch.setattr(chat, "materialize", lambda df, label: written.append(label) or real(df, label))
    edges = spark.range(1, 301).selectExpr("1 as conv_id", "concat('x', id) as call_id", "concat('x', id - 1) as needs")
    got = {r["call_id"]: r["depth"] for r in chat.topological_depth(edges).collect()}
    assert got == {f"x{i}": i for i in range(1, 301)} and len(written) <= 14


def test_op10_every_conversation_refers_back(spark):
    talk = spark.createDataFrame([(conv, t, "user" if t % 2 == 0 else "assistant", "some words") for conv in (6, 7) for t in range(9)],
                                 "conv_id long, turn long, role string, text string")
    calls, results = chat.calls_of(talk)
    out = chat.link_tools(talk, calls, results, chat.SCHEMAS)
    for kind, first in (("call", 1), ("result", 2)):
        got = {(r["conv_id"], r["turn"]): r["depth"] for r in out.where(F.col("kind") == kind).collect()}
        assert got == {(conv, first + 2 * k): k for conv in (6, 7) for k in range(4)}


def test_pipeline_stages(spark, tmp_path):
    own = ("lang_pred", "held_out", "n_lines", "removed", "_text_key", "_gone", "_doc")
    docs, folder = documents(spark).withColumns({c: F.lit(f"own {c}") for c in own}), str(tmp_path)
    columns = docs.columns
    long = next(r[1] for r in corpus() if r[0] == 4).split()
    spark.createDataFrame([(1, " ".join(long[5:30]))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    known = corpus_pipeline.language(spark, docs, folder)
    assert known.columns == columns
    ids = lambda df: sorted(str(r["doc_id"]) for r in df.select("doc_id").collect())
    assert ids(known) == sorted(str(r[0]) for r in corpus() if r[1] is not None and any(map(str.isalpha, r[1])))

    lined = corpus_pipeline.line_dedup(spark, known, folder)
    rows = [tuple(r) for r in known.collect()]
    gone = removed_by_brute_force(rows)
    want = {}
    for r in rows:
        kept = [x for n, x in enumerate(r[1].split("\n")) if (r[0], n) not in gone]
        if any(c.isalnum() for c in "".join(kept)):
            want[r[0]] = "\n".join(kept)
    assert lined.columns == columns and {r["doc_id"]: r["text"] for r in lined.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in lined.collect())

    single = corpus_pipeline.near_dedup(spark, known, folder)
    left = {r["doc_id"] for r in single.collect()}
    assert single.columns == columns and 1 in left and not left & {24, 25, 26, 27, 33, 34}  # near and exact copies
    clean = corpus_pipeline.decontamination(spark, known, folder)
    assert clean.columns == columns and set(ids(known)) - set(ids(clean)) == {"4"}
    mixed = corpus_pipeline.mix(spark, known, folder)
    assert set(columns) <= set(mixed.columns) and mixed.where("taken = 0").count() == 0

    for df in (known, lined, single, clean):  # a user's columns keep their values
        assert {(r["score"], *(r[c] for c in own)) for r in df.collect()} <= {(x, *(f"own {c}" for c in own)) for x in ("C", None)}

    out = corpus_pipeline.run(spark, folder)
    step = docs
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, folder)
    assert sorted(map(str, out.collect())) == sorted(map(str, step.select(*out.columns).collect())) and out.count() > 10
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_language_is_predicted_in_small_batches(spark, tmp_path):
    """The texts go to Python in a step of the stage's own, whatever batches its result is written in."""
    out = corpus_pipeline.language(spark, documents(spark), str(tmp_path))
    assert out.count() > 10 and "predict(" not in out._jdf.queryExecution().toString()


def test_small_batches_bound_bytes(spark):
    """Long texts go to Python some MB at a time, and the session's own limits come back."""
    names = [f"spark.sql.execution.arrow.{n}" for n in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before = [spark.conf.get(n) for n in names]

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    texts = spark.range(0, 12, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    got = wordlib.materialize(texts.mapInArrow(sizes, "n long, size long"), "sizes").collect()
    assert sum(r["n"] for r in got) == 12 and max(r["size"] for r in got) <= wordlib.BATCH_BYTES + (2 << 20)
    assert [spark.conf.get(n) for n in names] == before


def test_mix_runs_without_python_workers(spark):
    plan = mixing.mix_sources(documents(spark).where("doc_id > 3"))._jdf.queryExecution().toString()
    sizes = spark.range(3).select(F.col("id").cast("string").alias("source"), (F.col("id") * 10).alias("source_size"))
    targets = mixing.source_targets(sizes, [3, 1, 2], 1.5, 2)
    ranked = assign_dense_ids(sizes, ["source"], -1, "_rank")
    assert {r["source"]: r["_rank"] for r in ranked.collect()} == {"0": 0, "1": 1, "2": 2} and targets.count() == 3
    assert "Python" not in plan and "ExistingRDD" not in ranked._jdf.queryExecution().toString()
    assert assign_dense_ids(sizes.limit(0), ["source"], -1, "_rank").count() == 0


def test_queries_are_registered():
    import __spark_entry__ as entry
    from ordercraft.llm.queries import ORACLES, QUERIES

    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(QUERIES) and set(ORACLES) <= set(entry.oracle_sql())
