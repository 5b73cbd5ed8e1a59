"""WARC archives with a two-level capture index.

Pages are written as WARC/1.1 files, one record per page; equal payloads are stored once (response) and
revisited by the other records. Reading the files back gives every record's offset and length. The
captures, sorted by reversed-host URL key, are cut into compressed blocks; a sparse directory holds the
first and last key of each block. A look-up searches the directory, then bisects the blocks found, then reads byte ranges:
``lookup_urls`` for a table of URLs, in tasks, ``lookup`` for one URL.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ordercraft.operators.ids import dense_ids
from ordercraft.session import checkpoint_root, materialize

EOL = "\r\n"
GAP = EOL * 2  # after each record
FILE_BYTES = 8 << 20  # about so many payload bytes a file: a file is read by one task
BLOCK_LINES = 3000
GROUPS = 4096  # stretches of the directory, at most, whose first keys are sent to the tasks
DATE = "2024-01-01T00:00:00Z"

CAPTURE = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("surt", T.StringType()), T.StructField("file", T.StringType()),
    T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
])
NULL = "\\N"
# A CDX line: these fields, tab-separated.
_CDX = ["surt", "url", "payload_digest", "payload_bytes", "record_type", "page_id", "refers_to", "offset", "length", "file"]


@dataclass
class Archive:
    """Folders of one archive: WARC files, index blocks, block directory."""

    root: str

    @property
    def files(self) -> str:
        return f"{self.root}/warc"

    @property
    def blocks(self) -> str:
        return f"{self.root}/index"

    @property
    def directory(self) -> str:
        return f"{self.root}/directory"


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column (32 characters, no padding)."""
    digest = F.sha1(payload)
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    groups = []
    for k in range(8):  # 5 hex digits are 20 bits, or 4 letters
        value = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        groups += [F.substring(alphabet, F.shiftright(value, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*groups)


def mark_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html`` with payload columns, ``record_type`` and ``refers_to``.

    Of rows with equal payloads of at least ``min_bytes``, those with the largest page_id are responses and the others
    revisit it; shorter payloads are all responses. NULL html is an empty payload; a NULL page_id counts as the
    smallest; repeated rows with the largest page_id are all responses.

    Payloads are not shuffled: equal digests are found on narrow rows, and the revisits alone are joined back.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"),
                        F.octet_length(payload).cast("long").alias("payload_bytes"), payload_digest(payload).alias("payload_digest"))
    small = rows.select("page_id", "payload_digest").where(F.col("payload_bytes") >= min_bytes)
    newest = small.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("_n")).where("_n > 1")
    # Written first, so that its size is known when the join is planned.
    shared = materialize(newest.select("payload_digest", "refers_to"), "warc-shared")
    marked = rows.join(shared, "payload_digest", "left")
    revisit = (F.col("refers_to").isNotNull() & (F.col("payload_bytes") >= min_bytes)
               & ~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return marked.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col("refers_to")))


def one_line(url: Column) -> Column:
    """URLs keep to one field of one line: tabs and line breaks are percent-encoded."""
    for char, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09")):
        url = F.replace(url, F.lit(char), F.lit(code))
    return url


def _record() -> Column:
    """One record without the closing gap, which the text writer adds as its line separator."""
    def header(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(EOL))).otherwise(F.lit(""))

    http = F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{GAP}")
    is_revisit = F.col("record_type") == "revisit"
    body = F.when(is_revisit, F.lit("")).otherwise(F.col("html"))
    length = F.length(http) + F.when(is_revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("-"))
    return F.concat(
        F.lit(f"WARC/1.1{EOL}"), header("WARC-Type", F.col("record_type")),
        header("WARC-Target-URI", one_line(F.col("url"))),
        header("WARC-Date", F.lit(DATE)),
        header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page, F.lit(">"))),
        header("WARC-Refers-To", F.when(is_revisit, F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))),
        header("WARC-Profile", F.when(is_revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        header("X-Payload-Length", F.col("payload_bytes").cast("string")),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", length.cast("string")), F.lit(EOL), http, body)


def write_archive(pages: DataFrame, root: str, min_bytes: int = 0) -> Archive:
    """Write ``pages(page_id, url, html)`` as WARC files under ``root``; files follow the input's partitions."""
    archive = Archive(root)
    marked = mark_records(pages, min_bytes)
    mean = pages.agg(F.avg(F.octet_length("html"))).first()[0] or 1
    marked.select(_record().alias("value")).write.option("lineSep", GAP).option(
        "maxRecordsPerFile", max(1, int(FILE_BYTES / max(1, mean)))).mode("errorifexists").text(archive.files)
    return archive


_HEAD = re.compile(rb"([^:\r\n]+): ([^\r\n]*)\r\n")
_END = re.compile(rb"\r\n\r\n")


def parse_warc(data: bytes | memoryview) -> Iterator[tuple[int, int, dict[str, str], bytes | memoryview]]:
    """(offset, length, headers, HTTP body) of each record, by the records' own lengths. Nothing is copied."""
    at = 0
    while at < len(data):
        end = _END.search(data, at).end()
        head = {k.decode(): v.decode() for k, v in _HEAD.findall(data, at, end - 2)}
        stop = end + int(head["Content-Length"])
        body = _END.search(data, end).end()
        yield at, stop - at, head, data[body:stop]
        at = stop + len(GAP)


def _page(urn: str | None) -> int | None:
    return int(urn[10:-1]) if urn and urn != "<urn:page:->" else None


def surt(url: str | None) -> str:
    """Sort key: host labels reversed, without www, then port, path and query; '' for NULL."""
    try:
        u = urlsplit(url or "")
        host = ",".join(reversed(re.sub(r"^www\d*\.", "", u.hostname or "").split(".")))
        port = f":{u.port}" if u.port else ""
    except ValueError:  # not a URL: its text is the key
        return re.sub(r"\s", " ", url).lower()
    return re.sub(r"\s", " ", f"{host}{port}){u.path or '/'}{'?' + u.query if u.query else ''}".lower()) if url else ""


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """A row per record of the archive's files: CAPTURE columns. Payloads are checked against their digests."""
    def captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = []
                for offset, length, head, body in parse_warc(memoryview(data.as_buffer())):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Type"] == "response" and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                        raise ValueError(f"record at {offset} of {file} does not match its digest")
                    url = head.get("WARC-Target-URI")
                    rows.append((_page(head["WARC-Record-ID"]), url, int(head["X-Payload-Length"]), digest, head["WARC-Type"],
                                 _page(head.get("WARC-Refers-To")), surt(url), file.rsplit("/", 1)[1], offset, length))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    names = CAPTURE.fieldNames()
    types = [pa.int64() if isinstance(f.dataType, T.LongType) else pa.string() for f in CAPTURE]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(archive.files)
    return files.select("path", "content").mapInArrow(captures, CAPTURE)


def _field(value) -> str:
    """A value as a field of a CDX line: NULL is \\N, and a text that starts with a backslash gets another one."""
    text = NULL if value is None else str(value)
    return f"\\{text}" if value is not None and text.startswith("\\") else text


def _value(field: str) -> str | None:
    return None if field == NULL else field[1:] if field.startswith("\\") else field


def write_index(captures: DataFrame, archive: Archive, lines: int = BLOCK_LINES) -> None:
    """Sort the captures by key into compressed blocks, and write the directory of first keys.

    Each range partition writes its own blocks, so blocks are in key order over all partitions.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def flush(rows: list[dict]) -> pa.RecordBatch:
            text = "\n".join("\t".join(_field(r[c]) for c in _CDX) for r in rows)
            return pa.RecordBatch.from_pylist([{
                "first": rows[0]["surt"], "last": rows[-1]["surt"], "lines": len(rows), "block": zlib.compress(text.encode())}],
                schema=pa.schema([("first", pa.string()), ("last", pa.string()), ("lines", pa.int64()), ("block", pa.binary())]))

        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= lines:
                yield flush(held[:lines])
                held = held[lines:]
        if held:
            yield flush(held)

    # file and offset part equal keys, so one much captured URL spreads over several ranges
    key = ["surt", "file", "offset"]
    blocks = captures.select(*_CDX).repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(
        pack, "first string, last string, lines long, block binary")
    blocks.withColumn("block_id", F.monotonically_increasing_id()).write.mode("errorifexists").parquet(archive.blocks)
    captures.sparkSession.read.parquet(archive.blocks).select("block_id", "first", "last", "lines").write.mode(
        "errorifexists").parquet(archive.directory)


def _parse_block(block: bytes) -> list[list[str | None]]:
    return [[_value(v) for v in line.split("\t")] for line in zlib.decompress(block).decode().split("\n")]


_CDX_SCHEMA = T.StructType([CAPTURE[c] for c in _CDX])


def _cdx_batch(lines: list[list[str | None]]) -> pa.RecordBatch:
    fields = list(zip(*lines, strict=True)) if lines else [()] * len(_CDX)
    types = [pa.int64() if isinstance(f.dataType, T.LongType) else pa.string() for f in _CDX_SCHEMA]
    return pa.RecordBatch.from_arrays(
        [pa.array([None if v is None else int(v) for v in c] if t == pa.int64() else c, t) for c, t in zip(fields, types, strict=True)], names=_CDX)


def read_index(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every capture that the index blocks hold."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column("block").to_pylist():
                yield _cdx_batch(_parse_block(block))

    return spark.read.parquet(archive.blocks).select("block").mapInArrow(unpack, _CDX_SCHEMA)


def _directory_groups(directory: DataFrame) -> list[str]:
    """First keys of up to ``GROUPS`` stretches of consecutive blocks."""
    ranked, n = dense_ids(directory.select("first", "last", "block_id"), ["first", "last", "block_id"], 0, "at")
    step = max(1, -(-n // GROUPS))
    return sorted({r["first"] for r in ranked.where((F.col("at") - 1) % step == 0).select("first").collect()})


def lookup_urls(spark: SparkSession, archive: Archive, urls: DataFrame) -> DataFrame:
    """Captures of the URLs in ``urls(url)``, found through the directory: CDX columns, a row per capture.

    The directory is searched in two steps: a binary search among the first keys of at most ``GROUPS`` stretches, then a
    join within the stretch with the blocks whose keys span the URL's. Each block found goes to a task once, followed by
    the URLs' keys, which are bisected in it. Repeated URLs are looked up once; NULL finds the captures without a URL.
    """
    directory = spark.read.parquet(archive.directory)
    starts = _directory_groups(directory)
    text = T.StructType([T.StructField("key", T.StringType()), T.StructField("stretch", T.IntegerType())])

    @F.pandas_udf(text)
    def place(values: pd.Series) -> pd.DataFrame:
        keys = [surt(v) for v in values]
        return pd.DataFrame({"key": keys, "stretch": [max(0, bisect.bisect_right(starts, k) - 1) for k in keys]})

    @F.pandas_udf("int")
    def stretch(values: pd.Series) -> pd.Series:
        return pd.Series([max(0, bisect.bisect_right(starts, k) - 1) for k in values], dtype="int32")

    wanted = urls.select(one_line(F.col("url")).alias("url")).distinct().select("url", place("url").alias("p")).select("url", "p.*")
    # Captures of one key may begin in the stretch before the one that its first key opens.
    spans = directory.select("block_id", "first", "last", F.explode(F.sequence(stretch("first"), stretch("last"))).alias("stretch"))
    found = wanted.join(spans, "stretch").where((F.col("first") <= F.col("key")) & (F.col("key") <= F.col("last"))).select(
        "block_id", "key", "url").distinct()
    found = materialize(found, "warc-found")
    blocks = spark.read.parquet(archive.blocks).join(found.select("block_id").distinct(), "block_id", "left_semi")
    none = F.lit(None)
    stream = blocks.select("block_id", F.lit(False).alias("asked"), none.cast("string").alias("key"), none.cast("string").alias("url"), "block").unionByName(
        found.select("block_id", F.lit(True).alias("asked"), "key", "url", none.cast("binary").alias("block")))

    def bisected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: list[list[str | None]] = []
        keys: list[str] = []
        for batch in batches:
            hits = []
            for block, key, url in zip(*(batch.column(c).to_pylist() for c in ("block", "key", "url")), strict=True):
                if block is not None:
                    lines = _parse_block(block)
                    keys = [line[0] for line in lines]
                else:
                    hits += [x for x in lines[bisect.bisect_left(keys, key):bisect.bisect_right(keys, key)] if x[1] == url]
            yield _cdx_batch(hits)

    return stream.repartition("block_id").sortWithinPartitions("block_id", "asked", "key").mapInArrow(bisected, _CDX_SCHEMA)


def lookup(spark: SparkSession, archive: Archive, url: str) -> list[tuple[dict, bytes]]:
    """Records of one URL, each (headers, body), by binary search and range reads.

    The directory (a row per ``BLOCK_LINES`` captures) is searched by a pushed-down filter on its first and last keys
    and only matching blocks are fetched; a revisit's body is empty. An unknown URL gives an empty list.
    """
    key = surt(url)
    hits = spark.read.parquet(archive.directory).where((F.col("first") <= key) & (F.col("last") >= key)).select("block_id")
    blocks = spark.read.parquet(archive.blocks).join(hits, "block_id", "left_semi").orderBy("block_id")
    out = []
    for row in blocks.select("block").toLocalIterator():
        cdx = _parse_block(bytes(row["block"]))
        keys = [line[0] for line in cdx]
        for line in cdx[bisect.bisect_left(keys, key):bisect.bisect_right(keys, key)]:
            c = dict(zip(_CDX, line, strict=True))
            if c["url"] == url:
                data = read_range(spark, f"{archive.files}/{c['file']}", int(c["offset"]), int(c["length"]))
                _, _, head, body = next(parse_warc(data))
                out.append((head, body))
    return out


def read_range(spark: SparkSession, path: str, offset: int, length: int) -> bytes:
    """``length`` bytes at ``offset`` of a file in any store that Spark can open."""
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(file)
    try:
        stream.seek(offset)
        return bytes(stream.readNBytes(length))
    finally:
        stream.close()


def archive_pages(pages: DataFrame, root: str | None = None, min_bytes: int = 0) -> Archive:
    """Write, read back and index ``pages``; ``root`` defaults to a new folder in the shared checkpoint folder."""
    spark = pages.sparkSession
    archive = write_archive(pages, root or f"{checkpoint_root(spark).rstrip('/')}/ordercraft-warc-{uuid.uuid4().hex}", min_bytes)
    write_index(materialize(read_archive(spark, archive), "warc-captures"), archive)
    return archive


def op4_warc(spark, sf_dir: str) -> DataFrame:
    """The captures of every page's URL, looked up in the archive of all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return lookup_urls(spark, archive_pages(pages), pages.select("url")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
with p as (select page_id, coalesce(html, '') h from pages),
d as (select page_id, strlen(h)::bigint payload_bytes,
             array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               ((('0x' || substr(sha1(h), ((i // 4) * 5 + 1)::int, 5))::int >> (15 - 5 * (i % 4))::int) & 31) + 1, 1)), '') payload_digest
      from p),
m as (select *, max(page_id) over (partition by payload_digest) newest from d)
select page_id, payload_bytes, payload_digest,
       case when page_id is distinct from newest then 'revisit' else 'response' end record_type,
       case when page_id is distinct from newest then newest end refers_to
from m
"""
