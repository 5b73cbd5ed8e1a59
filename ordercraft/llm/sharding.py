"""Sharding documents over a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``VNODES`` random positions of a ring; the arc that ends at a position belongs to its shard. A document
goes to the arc that its key falls in, and from there clockwise past full shards. Capacities add up to the number of
documents and differ by at most one, so counts do too; with many virtual nodes only a few documents overflow, and another
shard moves few documents besides those it takes.

Documents are sorted round the ring once, by range partitions, which gives each its rank within its arc. How the shards
fill is decided on the arcs' counts alone (a table whose size is shards times virtual nodes, whatever the corpus): an arc's
documents enter or overflow by rank, so each arc ends up cut into a few runs of ranks, one shard each.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ordercraft.operators.ids import dense_ids
from ordercraft.session import materialize

SHARDS = 8
VNODES = 512
KEY_DIGITS = 15  # hex digits of md5 that make a ring position


def ring(shards: int, vnodes: int = VNODES) -> tuple[list[int], list[int]]:
    """Sorted ring positions and the shard of each."""
    places = sorted((int(hashlib.md5(f"{s}/{v}".encode()).hexdigest()[:KEY_DIGITS], 16), s)
                    for s in range(shards) for v in range(vnodes))
    return [p for p, _ in places], [s for _, s in places]


def fill(counts: dict[int, int], owners: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """How the arcs' documents spread: runs (arc, first rank, end rank, shard, first slot) from the documents of each arc.

    In turns, every arc offers its waiting documents to the next shard clockwise that is not full; a shard takes offers in
    ring order, and by rank, up to its capacity. A turn that leaves documents waiting has filled a shard, so there are no
    more turns than shards.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    waiting = {a: (0, n) for a, n in sorted(counts.items()) if n}
    runs = []
    while waiting:
        open_arcs = [a for a, s in enumerate(owners) if used[s] < room[s]]
        target = {a: owners[open_arcs[bisect.bisect_left(open_arcs, a) % len(open_arcs)]] for a in waiting}
        left = {}
        for arc, (first, end) in waiting.items():
            s = target[arc]
            take = min(end - first, room[s] - used[s])
            if take:
                runs.append((arc, first, first + take, s, used[s]))
                used[s] += take
            if first + take < end:
                left[arc] = (first + take, end)
        waiting = left
    return runs


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, key: str = "doc_id", with_text: bool = False,
) -> DataFrame:
    """``docs`` (without the text, unless ``with_text``) with ``size`` (UTF-8 bytes of the text plus 1), ``text_crc32``, ``home_shard``, ``shard`` and ``slot`` added
    (same-named columns are replaced); counts of shards differ by at most one, slots are gapless from 0 in each.

    Needs ``key`` and ``text``. A NULL text counts as empty; NULL keys share one place on the ring. Documents with one place
    go by key, size and crc; repeated rows get their places up to exchange among themselves, and however many there are,
    they are sorted by many tasks and overflow like others. With fewer documents than shards some shards stay empty; an
    empty table gives an empty result.
    """
    ends, owners = ring(shards, vnodes)
    at = np.array(ends, np.int64)

    @F.pandas_udf("int")
    def arc_of(place: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(at, place.to_numpy()) % len(at)).astype(np.int32))

    docs = docs.drop("size", "text_crc32", "home_shard", "shard", "slot")
    text = F.coalesce(F.col("text"), F.lit(""))
    digits = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, KEY_DIGITS)
    placed = (
        docs.withColumns({
            "size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text.cast("binary")),
            "_place": F.conv(digits, 16, 10).cast("long")})
        .withColumns({"_arc": arc_of("_place"), "_spread": F.monotonically_increasing_id()})
    )
    # Only narrow rows are sorted; the arc past the last position is the first one.
    carried = [c for c in placed.columns if with_text or c != "text"]
    placed = materialize(placed.select(*carried), "shard-places")
    past = (F.col("_place") > ends[-1]).cast("int")
    order = ["_wrap", "_place", key, "size", "text_crc32", "_spread"]
    ranked = materialize(dense_ids(placed.withColumn("_wrap", 1 - past), order, -1, "_rank")[0], "shard-ranks")

    # One row per arc, at most shards times vnodes.
    arcs = ranked.groupBy("_arc").agg(F.count("*").alias("n"), F.min("_rank").alias("first")).collect()
    runs = fill({r["_arc"]: r["n"] for r in arcs}, owners, shards)
    first = {r["_arc"]: r["first"] for r in arcs}
    spans = [(a, first[a] + i, first[a] + j, owners[a], s, slot) for a, i, j, s, slot in runs]
    table = docs.sparkSession.createDataFrame(
        spans, "_run_arc int, _from long, _to long, home_shard int, shard int, _slot long")
    inside = (F.col("_arc") == F.col("_run_arc")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    # At most shards times vnodes + shards squared rows.
    return ranked.join(F.broadcast(table), inside).withColumn("slot", F.col("_slot") + F.col("_rank") - F.col("_from")).drop(
        "_place", "_arc", "_spread", "_wrap", "_rank", "_run_arc", "_from", "_to", "_slot")


def op11_shard_ring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "home_shard")


def _oracle(shards: int = SHARDS, vnodes: int = VNODES) -> str:
    """The turns of ``fill`` on rows instead of counts, one after the other (there are no more than shards)."""
    turns = []
    for i in range(shards):
        pend = "d" if i == 0 else f"w{i - 1}"
        used = "select s, 0 n from c" if i == 0 else f"select c.s, count(g.s) n from c left join ({' union all '.join(f'select s from g{j}' for j in range(i))}) g using (s) group by c.s"
        turns.append(f"""
u{i} as materialized ({used}),
f{i} as materialized (select pos, r.s, c.cap - u.n free, u.n used from r join c using (s) join u{i} u using (s) where u.n < c.cap),
t{i} as materialized (
  select a.pos, coalesce(min(f.pos), (select min(pos) from f{i})) target
  from (select distinct arc pos from {pend}) a left join f{i} f on f.pos >= a.pos group by a.pos),
o{i} as materialized (
  select p.*, f.s, f.free, f.used, row_number() over (partition by f.s order by p.arc, p.wrap, p.place, p.doc_id nulls first, p.size, p.crc) k
  from {pend} p join t{i} t on t.pos = p.arc join f{i} f on f.pos = t.target),
g{i} as materialized (select doc_id, size, crc, home, s, used + k - 1 slot from o{i} where k <= free),
w{i} as materialized (select doc_id, size, crc, arc, wrap, place, home from o{i} where k > free)""")
    return rf"""
with tab as (
  select list_transform(range(256), lambda n: list_reduce([n] || range(8),
           lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) t),
r as materialized (
  select ('0x' || substring(md5(s || '/' || v), 1, {KEY_DIGITS}))::bigint pos, s::int s
  from range({shards}) a(s), range({vnodes}) b(v)),
b as materialized (
  select doc_id, coalesce(text, '') x, ('0x' || substring(md5(coalesce(doc_id::varchar, '')), 1, {KEY_DIGITS}))::bigint place
  from documents),
h as materialized (
  select doc_id, place, octet_length(encode(x)) + 1 size,
         xor(4294967295, list_reduce([4294967295::bigint] || list_transform(regexp_extract_all(hex(encode(x)), '..'),
             lambda h: ('0x' || h)::bigint), lambda c, y: xor(c >> 8, t[xor(c & 255, y) + 1]))) crc
  from b, tab),
m as (select min(pos) lo, max(pos) hi from r),
d as materialized (
  select h.doc_id, h.size, h.crc, e.arc, case when h.place > m.hi then 0 else 1 end wrap, h.place, e.home
  from h, m, lateral (select pos arc, s home from r where pos >= case when h.place > m.hi then m.lo else h.place end
                      order by pos limit 1) e),
c as materialized (
  select s::int s, (select count(*) from documents) // {shards} + (s < (select count(*) from documents) % {shards})::int cap
  from range({shards}) a(s)),{','.join(turns)}
select doc_id, size::bigint size, crc::bigint text_crc32, 'rows' law, s::int shard, slot::bigint slot,
       null::int grown_shard, home::int home_shard
from ({' union all '.join(f'select * from g{i}' for i in range(shards))})
"""


ORACLE = _oracle()
