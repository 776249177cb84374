"""Stream raw files through the cleaning transforms into Parquet tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from mercato.operators import cleaning
from mercato.session import shared_dir

# Raw (dirty) input schemas: texts are read as text and typed by cleaning.
RAW_SCHEMAS = {
    "customer_orders": "order_id bigint, customer_id bigint, pizza_id bigint, exclusions string, "
                       "extras string, order_time string",
    "runner_orders": "order_id bigint, runner_id bigint, pickup_time string, distance string, "
                     "duration string, cancellation string",
    "weekly_sales": "week_date string, region string, platform string, segment string, "
                    "customer_type string, transactions bigint, sales bigint",
}
CLEANERS = {
    "customer_orders": cleaning.clean_customer_orders,
    "runner_orders": cleaning.clean_runner_orders,
    "weekly_sales": cleaning.clean_weekly_sales,
}
PARTITION_BY = {"weekly_sales": ("calendar_year",)}


def clean_stream(spark: SparkSession, kind: str, source_dir: str, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of cleaned rows from raw files arriving in ``source_dir``."""
    reader = spark.readStream.schema(RAW_SCHEMAS[kind]).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return CLEANERS[kind](reader.load(source_dir))


def start_clean_sink(spark: SparkSession, kind: str, source_dir: str, table_dir: str,
                     checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Append cleaned rows to the Parquet table at ``table_dir``.

    The file sink with a checkpoint in the shared folder gives exactly-once
    output across restarts and lost executors. ``available_now`` processes
    what is there and stops; otherwise the query keeps running.
    """
    if checkpoint is None:
        folder = shared_dir(spark)
        if folder is None:
            raise ValueError("give a checkpoint folder, or set spark.checkpoint.dir")
        # A log for each source and target: sinks of one kind do not share one.
        own = hashlib.sha256(f"{source_dir}\n{table_dir}".encode()).hexdigest()[:16]
        checkpoint = f"{folder.rstrip('/')}/streams/{kind}-{own}"
    w = (clean_stream(spark, kind, source_dir).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if kind in PARTITION_BY:
        w = w.partitionBy(*PARTITION_BY[kind])
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(table_dir)
