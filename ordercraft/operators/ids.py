"""Dense, ordered ids without a global window.

The source draws ids from a sequence, one per new refill group and per error
row, so ids rise with processing order. A window over the whole input would run
in a single task, so instead:

1. range-partition the rows on the sort key (balanced by sampling; contiguous
   ranges, so partition order is key order, also after AQE coalescing),
2. write the rows with their partition number to the shared checkpoint folder,
   which pins them (a recomputation could not renumber them),
3. count rows per partition (one small row per partition) and turn the counts
   into start offsets,
4. number rows inside each partition with a window partitioned by that number.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ordercraft.session import materialize


def max_or(df: DataFrame, column: str, default: int = 0) -> int:
    """``max(column)`` of ``df`` as a driver value (one aggregate row)."""
    value = df.agg(F.max(column)).first()[0]
    return default if value is None else int(value)


ROWS_PER_PARTITION = 100_000


def dense_ids(df: DataFrame, order_cols: list[str], base: int, id_col: str) -> tuple[DataFrame, int]:
    """``df`` with ``id_col`` = base + 1, base + 2, ... in ``order_cols`` order (ascending, NULLs first), and the last id.

    ``df`` should be a written table: it is counted, sampled and read. The partition count follows the row count.
    """
    spark = df.sparkSession
    n = max(1, -(-df.count() // ROWS_PER_PARTITION))
    ranged = materialize(df.repartitionByRange(n, *order_cols).withColumn("_part", F.spark_partition_id()), "ids")
    counts = sorted((r["_part"], r["count"]) for r in ranged.groupBy("_part").count().collect())
    offsets, acc = [], base
    for part, c in counts:
        offsets.append((part, acc))
        acc += c
    # One row per range partition, as an Arrow table: a list of rows would go through Python workers of their own.
    parts, starts = zip(*(offsets or [(0, base)]))
    offset_df = spark.createDataFrame(pa.table({"_part": pa.array(parts, pa.int32()), "_offset": pa.array(starts, pa.int64())}))
    within = Window.partitionBy("_part").orderBy(*order_cols)
    numbered = (
        ranged.join(F.broadcast(offset_df), "_part")
        .withColumn(id_col, (F.col("_offset") + F.row_number().over(within)).cast("bigint"))
        .drop("_part", "_offset")
    )
    return numbered, acc


def assign_dense_ids(df: DataFrame, order_cols: list[str], base: int, id_col: str) -> DataFrame:
    """``dense_ids`` without the last id."""
    return dense_ids(df, order_cols, base, id_col)[0]
