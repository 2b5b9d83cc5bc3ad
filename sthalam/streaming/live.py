"""The parse as a stream: cleaning row by row, matching by micro-batch, and running counts over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sthalam.plans.parse import parse_addresses, prepare
from sthalam.plans.project_match import Dimensions


def clean_stream(rows: DataFrame, address: str = "address", zip_code: str = "zip") -> DataFrame:
    """A stream of rows with the prepared columns; no state is kept."""
    return prepare(rows, address, zip_code)


def match_stream(rows: DataFrame, dims: Dimensions, out: str, checkpoint: str, *, key: str = "row_id") -> StreamingQuery:
    """Parses each micro-batch as a table and writes it under its batch number, so that a repeated batch replaces itself."""

    def one(batch: DataFrame, number: int) -> None:
        parse_addresses(batch.select(key, "address", "state_code", "zip"), dims, key=key).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_counts(events: DataFrame, *, at: str = "ts", by: str = "event_type", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window_start, `by`, n) of a stream over event time; rows later than the watermark are left out."""
    w = events.withWatermark(at, late).groupBy(F.window(at, window), by).agg(F.count("*").alias("n"))
    return w.select(F.col("window.start").alias("window_start"), by, "n")
