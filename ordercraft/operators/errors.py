"""Error rows (J12, D9): rejected inserts appended to the error table with fresh ids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ordercraft.functions.scalars import ts_lit
from ordercraft.operators.ids import dense_ids, max_or
from ordercraft.sources.schemas import TARGETS


def error_rows(
    current: DataFrame,
    rejected: dict[str, DataFrame],
    as_of: dt.datetime,
    id_base: int | None = None,
    cut=lambda df: df,
) -> tuple[DataFrame, int]:
    """New error rows for ``rejected`` = {source: (order_id, error_code, error)}, and the last id given.

    ``cut`` (e.g. a written stage table) is applied to the rejected rows, which are counted and numbered. Ids continue after ``id_base`` (default: the largest stored id) in the pinned order
    source 'R' before 'A', then order id, then message.
    """
    parts = [
        df.select("order_id", "error_code", F.substring("error", 1, 200).alias("error"), F.lit(src).alias("source"))
        for src, df in rejected.items()
    ]
    base = max_or(current, "id") if id_base is None else id_base
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = cut(rows.withColumn("_src_rank", F.when(F.col("source") == "R", 0).otherwise(1)))
    numbered, last = dense_ids(rows, ["_src_rank", "order_id", "error", "error_code"], base, "id")
    return numbered.select(
        "id", "order_id", "error", ts_lit(as_of).alias("error_date"),
        F.col("error_code").cast("int").alias("error_code"), "source",
    ).select(*TARGETS["cit_opp_errors"].fieldNames()), last
