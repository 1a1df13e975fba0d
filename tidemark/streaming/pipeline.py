"""Structured Streaming ingestion: change events -> lake -> warehouse.

``foreachBatch`` runs, per micro-batch and in this order:

1. payload gate (stop-the-line): raising here fails the query before any
   write, and the offsets of that batch are not committed.  With a ``quarantine``
   folder the gate holds back single events instead: they are stored there with
   their reasons, under the stream's epoch (a replayed epoch replaces its own
   folder), and the good events go on;
2. lake append, always: a replayed epoch finds its sequences already stored
   and writes nothing.  Batch ids are the lake's own, so restores, batch
   ingests, other streams and new checkpoints share a lake safely; stream and
   epoch are noted in the commit marker for information only;
3. warehouse apply of every lake batch not applied yet (the one just
   written, and any left over by a crash between lake and warehouse).

Spark commits the source offsets only after ``foreachBatch`` returns, so a
crash at any step replays the batch, and every step is idempotent.  Late
and out-of-order events are handled by the warehouse apply (general path).
"""

from __future__ import annotations

import hashlib
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.contracts import LAKE_COLUMNS, LAKE_SCHEMA, Contract
from tidemark.operators import lake as lm
from tidemark.operators import quarantine as q
from tidemark.operators import schema_gate
from tidemark.operators.ingest import apply_pending
from tidemark.operators.warehouse import Warehouse

logger = logging.getLogger(__name__)


def read_feed_files(spark: SparkSession, landing: str, fmt: str = "parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming change feed from files dropped into ``landing``
    (a Kafka source with the same columns is a drop-in replacement)."""
    reader = spark.readStream.schema(LAKE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing)


def make_batch_handler(lake_path: str, warehouse: Warehouse | None, gate: bool = True, metrics: list | None = None,
                       contract: Contract | None = None, stream: str = "stream", quarantine: str | None = None):
    """``contract``: what the payload gate checks, the warehouse's by default; a
    stream into the lake alone is gated if it names one.  ``quarantine``: folder for
    events that the gate holds back instead of stopping the line."""
    contract = contract or (warehouse.contract if warehouse is not None else None)
    if quarantine is not None and contract is None:
        raise ValueError("a quarantine needs a contract to judge events by")
    sink = hashlib.blake2b(stream.encode(), digest_size=6).hexdigest()

    def handle(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        feed = batch.select(*LAKE_COLUMNS)
        if quarantine is not None:
            rows = q.judged(feed, contract).persist()
            q.store(rows.where(F.size(q.REASONS) > 0), quarantine, f"{sink}-{int(epoch_id)}")
            feed = rows.where(F.size(q.REASONS) == 0).select(*LAKE_COLUMNS)
        else:
            rows = feed = feed.persist()
        try:
            check = gate and contract is not None and quarantine is None
            stats = lm.door_stats(feed, schema_gate.gate_aggs(contract) if check else [],
                                  schema_gate.gate_prepare(contract) if check else None,
                                  known=contract.names if contract is not None else None)
            if check:
                schema_gate.raise_if_gate_failed(stats.extra)
            res = lm.append(spark, lake_path, feed, stats=stats,
                            marks=warehouse.marks() if warehouse is not None else None,
                            info={"stream": stream, "epoch": int(epoch_id)})
            reports = apply_pending(spark, lake_path, warehouse, res) if warehouse is not None else []
            if metrics is not None:
                metrics.append({"epoch": int(epoch_id), "append": res, "apply": reports})
        finally:
            rows.unpersist()
    return handle


def start(feed: DataFrame, lake_path: str, warehouse: Warehouse | None, checkpoint: str,
          available_now: bool = False, processing_time: str | None = None, gate: bool = True,
          dedup_watermark: str | None = None, metrics: list | None = None,
          contract: Contract | None = None, quarantine: str | None = None) -> StreamingQuery:
    """Run the ingestion stream.  ``dedup_watermark`` (e.g. "1 hour")
    adds ``dropDuplicatesWithinWatermark`` on sequence as a cheap pre-filter;
    exact dedup always happens against the lake."""
    if dedup_watermark:
        # Watermarks need a zoned TIMESTAMP; captured_at is UTC wall clock (NTZ)
        # and the session zone is UTC, so the cast keeps the instant.
        feed = (feed.withColumn("_event_time", F.col("captured_at").cast("timestamp"))
                .withWatermark("_event_time", dedup_watermark)
                .dropDuplicatesWithinWatermark(["sequence"])
                .drop("_event_time"))
    writer = (feed.writeStream.foreachBatch(make_batch_handler(lake_path, warehouse, gate, metrics, contract, checkpoint, quarantine))
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_available(feed: DataFrame, lake_path: str, warehouse: Warehouse | None, checkpoint: str,
                  gate: bool = True, metrics: list | None = None, dedup_watermark: str | None = None,
                  contract: Contract | None = None, quarantine: str | None = None) -> None:
    """Process everything available now, then stop (batch-style stream run)."""
    q = start(feed, lake_path, warehouse, checkpoint, available_now=True, gate=gate, metrics=metrics,
              dedup_watermark=dedup_watermark, contract=contract, quarantine=quarantine)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
