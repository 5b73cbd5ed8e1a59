"""The staged job driven by a stream of staged order ids.

In the source, a staging table lists orders to process and every run reads all of
it. Here new staged order ids arrive as Parquet files in a folder; a Structured
Streaming query picks up each new batch and ``foreachBatch`` runs the staged job
with that batch as the work list. The batch number is part of the run's one commit,
so a batch that is replayed after a failure either runs again as a whole or, if it
was committed, is skipped.

Batches are runs of their own, in order: ids are given per batch, so processing the
orders in two batches numbers them by batch first, as two runs of the source would.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ordercraft.plans.jobs import Options, run_staged
from ordercraft.session import materialize, run_folder
from ordercraft.sources.binding import Tables
from ordercraft.sources.schemas import INPUTS
from ordercraft.sources.tables import TableStore


def start_staged_stream(
    spark: SparkSession,
    tables: Tables,
    staged_dir: str,
    store: TableStore,
    checkpoint_location: str,
    as_of: Callable[[], dt.datetime] = dt.datetime.now,
    available_now: bool = False,
    processing_time: str = "5 minutes",
    max_files_per_trigger: int | None = None,
    options: Options = Options(),
) -> StreamingQuery:
    """Start the stream; each micro-batch is one committed run of ``store``.

    ``checkpoint_location`` must stay the same over restarts, or the stream starts over.
    """
    reader = spark.readStream.schema(INPUTS["dcspp_order_item_stg"])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    staged = reader.parquet(staged_dir)

    def process(batch: DataFrame, batch_id: int) -> None:
        with run_folder(spark):
            work = materialize(batch.select("order_id").distinct(), f"staged-batch-{batch_id}")
            run_staged(tables.replace(dcspp_order_item_stg=work), as_of(), store, options, batch_id)

    writer = staged.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
