"""Target tables (S6, D1-D9 sinks): written folders, made current by one manifest per run.

Parquet tables take no MERGE/UPDATE/DELETE, so a run writes the next version of what it changes to new folders. Nothing
it writes is visible until its manifest is: one small JSON file that names the folders of every table, the id high-water
marks and the stream batch. It is written under a temporary name and renamed, so a run takes effect as a whole or not at
all; a crashed run leaves only folders that no manifest names.

Tables with a ``Layout`` are cut into pieces by a hash of a key (bucket), and refills also by the month they expire in. A run
reads and rewrites only the buckets that hold keys it changes, and names the other pieces again; a purge drops the pieces
of whole months. A run computes on the state that it read: a commit names that state and is refused if another run was
committed since.
"""

from __future__ import annotations

import json
import re
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ordercraft.session import freed_shuffles
from ordercraft.sources.schemas import QUARANTINE, STATES, TARGETS, conform, empty

SCHEMAS = {**TARGETS, **STATES, "quarantine": QUARANTINE}
BUCKETS = 4  # of a new store by default: for small targets; large ones take so many that a bucket is some 256 MB
NO_MONTH = "none"
MOST_WRITERS = 8  # buckets of a wide table up to which a task writes a file for each
ROW_GROUP = 32 << 20  # of these files, as many of which are open at once
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@dataclass(frozen=True)
class Layout:
    """``key``: the column whose hash names the bucket; ``month``: the date column whose month names the piece.

    ``wide``: rows are so wide that they are written by the tasks that have them, not moved to a task per bucket first.
    """

    key: str
    month: str | None = None
    wide: bool = False


LAYOUTS = {
    "cit_refil": Layout("order_id", "expiration"),
    "cit_opportunities": Layout("cf_id"),
    "latest_orders": Layout("cf_id"),
    "order_details": Layout("order_number", wide=True),
    "brand_days": Layout("cf_id", "day"),
}


class StaleRun(RuntimeError):
    """Another run was committed after the state that this one computed on."""


@dataclass
class State:
    """What a manifest says."""

    run: int = 0
    tables: dict[str, list[str]] = field(default_factory=dict)
    sequences: dict[str, int] = field(default_factory=dict)
    batch: int | None = None
    buckets: int = 0


def bucket_of(piece: str) -> int:
    return int(re.search(r"/bucket=(\d+)", piece)[1])


def month_of(piece: str) -> str | None:
    """``yyyyMM``; None for rows without a date."""
    month = re.search(r"/month=(\w+)", piece)[1]
    return None if month == NO_MONTH else month


class TableStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        """``buckets`` counts for a new store; an existing one keeps the number it was made with."""
        self.spark = spark
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._buckets = buckets

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _runs(self) -> list[str]:
        folder = self._path("_manifests")
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(n for n in names if re.fullmatch(r"\d{10}\.json", n))

    def state(self) -> State:
        """The newest manifest; an empty state only if the store has none. Storage errors are raised."""
        runs = self._runs()
        if not runs:
            return State(buckets=self._buckets)
        stream = self._fs.open(self._path(f"_manifests/{runs[-1]}"))
        try:
            return State(**json.loads(bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()

    # -- reading --------------------------------------------------------------------------

    def read(self, table: str, state: State | None = None, buckets: set[int] | None = None) -> DataFrame:
        """``table`` as ``state`` has it (default: the newest), or only the pieces of ``buckets``."""
        pieces = (state or self.state()).tables.get(table, [])
        return self.read_pieces(table, pieces if buckets is None else [p for p in pieces if bucket_of(p) in buckets])

    def read_pieces(self, table: str, pieces: list[str]) -> DataFrame:
        paths = [f"{self.root}/{p}" for p in pieces]
        return self.spark.read.schema(SCHEMAS[table]).parquet(*paths) if paths else empty(self.spark, SCHEMAS[table])

    def sequence(self, name: str) -> int:
        return self.state().sequences.get(name, 0)

    def bucket(self, key: Column, state: State) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(state.buckets)).cast("int")

    def touched(self, rows: DataFrame, table: str, state: State) -> set[int]:
        """The buckets of ``table`` that the keys of ``rows`` fall in (as many values as buckets, at most)."""
        got = rows.select(self.bucket(F.col(LAYOUTS[table].key), state).alias("b")).distinct().collect()
        return {r["b"] for r in got}

    # -- writing --------------------------------------------------------------------------

    def write(self, table: str, df: DataFrame, state: State | None = None) -> list[str]:
        """Write rows of ``table`` to a new folder, not yet visible; returns its pieces."""
        folder = f"{table}/{uuid.uuid4().hex}"
        rows, layout = conform(df, SCHEMAS[table], empty_strings_as_null=False), LAYOUTS.get(table)
        if layout is None:
            with freed_shuffles(rows.sparkSession):
                rows.write.mode("errorifexists").parquet(f"{self.root}/{folder}")
            return [folder]
        parts = {"bucket": self.bucket(F.col(layout.key), state or self.state())}
        if layout.month:
            parts["month"] = F.coalesce(F.date_format(layout.month, "yyyyMM"), F.lit(NO_MONTH))
        rows, writers = rows.withColumns(parts), (state or self.state()).buckets
        if layout.wide and writers <= MOST_WRITERS:
            # A file per task and bucket, all open at once, so rows are neither shuffled nor sorted by bucket.
            with self._open_files(writers):
                self._write_parts(rows, parts, folder, **{"compression": "zstd", "parquet.block.size": str(ROW_GROUP)})
        else:
            # Rebalanced by piece: one file for each, and a large bucket is split over tasks.
            self._write_parts(rows.hint("rebalance", *parts), parts, folder)
        pieces = [folder]
        for _ in parts:
            pieces = [f"{p}/{f.getPath().getName()}" for p in pieces for f in self._fs.listStatus(self._path(p))
                      if f.isDirectory() and "=" in f.getPath().getName()]
        return sorted(pieces)

    def _write_parts(self, rows: DataFrame, parts: dict[str, Column], folder: str, **options: str) -> None:
        with freed_shuffles(rows.sparkSession):
            rows.write.mode("errorifexists").options(**options).partitionBy(*parts).parquet(f"{self.root}/{folder}")

    @contextmanager
    def _open_files(self, most: int):
        """Tasks keep up to ``most`` files open instead of sorting their rows by file."""
        conf = self.spark.conf
        before = conf.get(OPEN_FILES)
        conf.set(OPEN_FILES, str(most))
        try:
            yield
        finally:
            conf.set(OPEN_FILES, before)

    def swapped(self, table: str, state: State, buckets: set[int], pieces: list[str]) -> list[str]:
        """The table's pieces with those of ``buckets`` replaced by ``pieces``."""
        return [p for p in state.tables.get(table, []) if bucket_of(p) not in buckets] + pieces

    def commit(
        self, start: State, tables: dict[str, list[str]], sequences: dict[str, int] | None = None, batch: int | None = None,
    ) -> int:
        """Make written pieces current, all at once; returns the run's number.

        ``start`` is the state that the run read; ``tables`` names all pieces of the tables that change. Raises ``StaleRun``
        if another run was committed since: what was computed would undo it.
        """
        new = State(start.run + 1, {**start.tables, **tables}, {**start.sequences, **(sequences or {})},
                    start.batch if batch is None else batch, start.buckets)
        name = self._path(f"_manifests/{new.run:010d}.json")
        draft = self._path(f"_manifests/_{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(new.__dict__).encode()))
        finally:
            out.close()
        runs = self._runs()
        newest = int(runs[-1][:10]) if runs else 0
        if newest != start.run or self._fs.exists(name) or not self._fs.rename(draft, name):
            self._fs.delete(draft, False)
            raise StaleRun(f"run {new.run} was computed on run {start.run}, but run {newest} is current")
        return new.run

    def seed(self, tables: dict[str, DataFrame]) -> None:
        """Commit initial versions (e.g. the test binding's seeded targets)."""
        state = self.state()
        self.commit(state, {name: self.write(name, df, state) for name, df in tables.items()})
