"""Loading raw exports into the declared types without changing a value.

A value is lossy if its column's declared type cannot hold it: text that does not parse, digits beyond the declared scale,
numbers out of range, CSV records with too few or too many fields. ``ingest`` fails on the first such value when its rows
are read; ``ingest_exports`` sets the rows aside in a reject table and then fails, or goes on if asked to.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ordercraft.sources.schemas import INPUTS, TARGETS

SCHEMAS = {**INPUTS, **TARGETS}
CORRUPT = "_corrupt_record"
REJECTS = "_rejects"
WIDE = "decimal(38,18)"  # holds every value of the declared number types, and 16 digits after the cents
REJECT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("table", "column", "value", "reason", "record")])


class LossyExport(ValueError):
    """An export has values that the declared types cannot hold."""


def typed(source: T.StructField, target: T.DataType) -> tuple[Column, Column | None, str]:
    """(value in the declared type or NULL, whether the value would change, what is wrong); None where it cannot change."""
    col = F.col(f"`{source.name}`")
    # '' is NULL in the source's database, whatever the type.
    text = isinstance(source.dataType, T.StringType)
    given = F.nullif(col, F.lit("")) if text else col
    if source.dataType == target or isinstance(target, T.StringType):
        return given.cast(target) if not text else given, None, ""
    value = (F.trim(given) if text else given).try_cast(target)
    wrong = given.isNotNull() & value.isNull()
    if isinstance(target, (T.DecimalType, T.IntegralType)):
        number = F.trim(given) if text else given
        wide = number.try_cast(WIDE)
        wrong = wrong | F.coalesce(wide != value.cast(WIDE), F.lit(False))
        if text:  # digits that even the wide type would round away
            wrong = wrong | F.coalesce(number.rlike(r"\.\d{18}\d*[1-9]"), F.lit(False))
        # A whole number is read through the wide type, so that '7.0' is 7 and '7.5' is refused.
        if isinstance(target, T.IntegralType):
            value = wide.try_cast(target)
            wrong = given.isNotNull() & (value.isNull() | (wide != value.cast(WIDE)))
    return value, wrong, f"does not fit {target.simpleString()}"


def _fields(df: DataFrame, name: str) -> list[tuple[str, Column, Column | None, str]]:
    by_name = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in SCHEMAS[name].fields:
        if f.name not in by_name:
            raise LossyExport(f"{name} has no column {f.name}")
        out.append((f.name, *typed(by_name[f.name], f.dataType)))
    return out


def ingest(df: DataFrame, name: str) -> DataFrame:
    """A raw export of table ``name`` in its declared types, ``''`` as NULL; reading a lossy value raises an error."""
    cols = []
    for column, value, wrong, why in _fields(df, name):
        if wrong is not None:
            said = F.concat(F.lit(f"{name}.{column}: "), F.col(f"`{column}`").cast("string"), F.lit(f" {why}"))
            value = F.when(wrong, F.raise_error(said).cast(SCHEMAS[name][column].dataType)).otherwise(value)
        cols.append(value.alias(column))
    return df.select(*cols)


def split(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows in the declared types, rejects): a row with any lossy value is rejected, with a reject row for each.

    Rejects are (table, column, value, reason, record), the record as JSON.
    """
    fields = _fields(df, name)
    known = {f.name for f in SCHEMAS[name].fields}
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != CORRUPT]))
    tests = [F.when(wrong, F.struct(F.lit(column).alias("column"), F.col(f"`{column}`").cast("string").alias("value"), F.lit(why).alias("reason")))
             for column, _, wrong, why in fields if wrong is not None]
    if CORRUPT in df.columns and CORRUPT not in known:
        tests.append(F.when(F.col(CORRUPT).isNotNull(), F.struct(
            F.lit(None).cast("string").alias("column"), F.col(CORRUPT).alias("value"), F.lit("malformed record").alias("reason"))))
    if not tests:
        return df.select(*[v.alias(c) for c, v, _, _ in fields]), df.sparkSession.createDataFrame([], REJECT_SCHEMA)
    faults = df.withColumn("_faults", F.filter(F.array(*tests), lambda x: x.isNotNull()))
    good = faults.where(F.size("_faults") == 0).select(*[v.alias(c) for c, v, _, _ in fields])
    bad = faults.where(F.size("_faults") > 0).withColumn("record", record).select("record", F.explode("_faults").alias("f"))
    return good, bad.select(F.lit(name).alias("table"), "f.column", "f.value", "f.reason", "record")


def profile(df: DataFrame, name: str) -> DataFrame:
    """One row per column: (column, type, n, nulls, lossy, scale, low, high), in one pass over the export.

    ``scale`` is the number of digits that the values need after the point; ``low`` and ``high`` are the range as numbers.
    Shows which declared type would hold an export that is refused.
    """
    by_name = {f.name.lower(): f for f in df.schema.fields}
    parts = []
    for column, _, wrong, _ in _fields(df, name):
        col, kind = F.col(f"`{by_name[column].name}`"), SCHEMAS[name][column].dataType
        given = F.nullif(col, F.lit("")) if isinstance(by_name[column].dataType, T.StringType) else col
        number = isinstance(kind, (T.DecimalType, T.IntegralType))
        digits = F.length(F.regexp_extract(F.trim(given.cast("string")), r"\.(\d*[1-9])0*$", 1))
        wide = F.trim(given.cast("string")).try_cast(WIDE)
        none = F.lit(None)
        parts.append(F.struct(
            F.lit(column).alias("column"), F.lit(kind.simpleString()).alias("type"), F.count(F.lit(1)).alias("n"),
            F.count_if(given.isNull()).alias("nulls"),
            (F.lit(0).cast("long") if wrong is None else F.count_if(wrong)).alias("lossy"),
            (F.max(digits) if number else none.cast("int")).alias("scale"),
            (F.min(wide) if number else none.cast(WIDE)).alias("low"),
            (F.max(wide) if number else none.cast(WIDE)).alias("high")))
    return df.agg(*[p.alias(f"_{i}") for i, p in enumerate(parts)]).select(
        F.inline(F.array(*[F.col(f"_{i}") for i in range(len(parts))])))


def read_export(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A raw export. CSV files need a header; their fields are read as text, malformed records marked in ``_corrupt_record``."""
    if fmt != "csv":
        return spark.read.options(**options).format(fmt).load(path)
    options = {"header": "true", **options}
    names = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    # Without column pruning the number of fields of every record is checked.
    return spark.read.options(
        **{**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false"}).schema(schema).csv(path)


def ingest_exports(
    spark: SparkSession, exports: Mapping[str, str], out_root: str, fmt: str = "parquet", keep_rejects: bool = False, **options: str,
):
    """Load raw table exports (Parquet or CSV with a header) into normalized Parquet tables, sorted by their keys.

    Columns are matched by name and read in their declared types; extra columns are dropped. Rows with a value that would
    change are left out and written to ``out_root/_rejects``; unless ``keep_rejects``, any such row then raises
    ``LossyExport``. Returns the tables read back from ``out_root``, ready for the jobs.
    """
    from ordercraft.sources.binding import Tables
    from ordercraft.sources.lookup import write_clustered

    paths, rejected = {}, {}
    for name, path in exports.items():
        good, bad = split(read_export(spark, path, fmt, **options), name)
        write_clustered(good, name, f"{out_root}/{name}")
        bad.write.mode("append").parquet(f"{out_root}/{REJECTS}/{name}")
        n = spark.read.schema(REJECT_SCHEMA).parquet(f"{out_root}/{REJECTS}/{name}").count()
        if n:
            rejected[name] = n
        paths[name] = f"{out_root}/{name}"
    if rejected and not keep_rejects:
        raise LossyExport(f"values that would change (rows in {out_root}/{REJECTS}): {rejected}")
    return Tables.from_paths(spark, paths)
