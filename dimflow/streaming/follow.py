"""Dimension merges as a file stream, for runs that keep a stream checkpoint, not a mark."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from dimflow.operators.enrich import enrich_loans
from dimflow.plans.jobs import LANDED_SCHEMA, Batch, latest_date, read_ingested, scd2, scd4
from dimflow.schemas import DIMENSIONS, VALID, DimSpec
from dimflow.streaming.incremental import utc_from_micros


def merge_arrived(
    spark: SparkSession,
    landing_path: str,
    dims_path: str,
    checkpoint_path: str,
    process_date: dt.date | None = None,
    scd_type: int = 2,
    specs: Iterable[DimSpec] = DIMENSIONS,
) -> None:
    """Merge the valid rows of landed files not seen before, then stop.

    The batches waiting are merged one by one in the order of their arrival, each with its own date, as `run_batch` does, and
    late ones are spliced in. With a ``process_date`` all files waiting form one batch of that date instead, so
    the latest row of a key is chosen among all of them.

    Each merge happens once: the commit row names the stream, its micro-batch and the batch in it. When the stream replays a
    micro-batch after a failure, a dimension that has committed a batch of it is not compared with it again.

    The stream itself carries what has arrived, not the rows: all columns of a micro-batch are read each time that something reads
    it, where a scan of the landed files reads those that are asked for.
    """
    specs = tuple(specs)
    merge = {2: scd2, 4: scd4}[scd_type]
    stream = hashlib.sha256(checkpoint_path.encode()).hexdigest()[:16]

    def apply(arrivals: DataFrame, batch_id: int) -> None:
        session, source = arrivals.sparkSession, f"{stream}/{batch_id}"
        # A row per input that has landed since the last run.
        micros = F.unix_micros("ingestion_timestamp").alias("micros")
        parts = arrivals.select(micros, "batch", "input").distinct().orderBy("micros", "batch", "input").collect()
        if process_date is not None:
            merge(session, _landed(session, landing_path, parts), dims_path, process_date, specs, source=source)
            return
        for part in parts:
            arrived, seen = utc_from_micros(part.micros), None
            if part.batch < latest_date(session, landing_path, arrived):
                seen = enrich_loans(read_ingested(session, landing_path))
                seen = seen.filter(F.col("ingestion_timestamp") <= F.lit(arrived))
            own = _landed(session, landing_path, [part])
            merge(session, own, dims_path, part.batch, specs, seen, f"{source}/{part.batch}/{part.input}")

    arrived = spark.readStream.schema(LANDED_SCHEMA).parquet(f"{landing_path}/rows")
    query = (
        arrived.filter(F.col("outcome") == VALID)
        .select("ingestion_timestamp", "batch", "input")
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _landed(spark: SparkSession, landing_path: str, parts: list[Row]) -> DataFrame:
    """The valid rows of some inputs as they landed at some times, enriched."""
    batches = dict.fromkeys(Batch(part.batch, part.input) for part in parts)
    times = [utc_from_micros(part.micros) for part in parts]
    rows = read_ingested(spark, landing_path, list(batches) or None)
    return enrich_loans(rows.filter(F.col("ingestion_timestamp").isin(*times)))
