"""Batch ingestion: gate -> lake -> warehouse, in that order.

A failure after the lake write leaves the warehouse on its previous version.
The batch id was taken before the first row was written, and its lease is
renewed while the append runs.  A batch is *pending* once its append ended or
died: the next run, of the same or of any other input, applies it first and
converges to the same state.  A batch that is still being written is left to its
writer, whatever other ids are applied meanwhile.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import lake as lm
from tidemark.operators.warehouse import ApplyReport, Warehouse


@dataclass
class IngestReport:
    append: lm.AppendResult
    applied: list[ApplyReport] = field(default_factory=list)


def pending_batches(spark: SparkSession, lake_path: str, warehouse: Warehouse) -> list[int]:
    """Lake batches that ended or died and are not yet applied to every touched table, in order."""
    done = set(warehouse.applied_batches())
    return [b for b in lm.settled_batches(spark, lake_path) if b not in done]


def apply_pending(spark: SparkSession, lake_path: str, warehouse: Warehouse,
                  res: lm.AppendResult | None = None) -> list[ApplyReport]:
    """Apply what is pending.  ``res``: an append that has just run; its observed
    counts describe its whole batch, others are counted from the lake."""
    reports = []
    for b in pending_batches(spark, lake_path, warehouse):
        log = lm.read_log(spark, lake_path)
        if b in log.open:
            lm.declare_dead(spark, lake_path, b)
        known = res.tables if res is not None and b == res.batch_id else None
        reports += warehouse.apply(lake_path, lm.read_batches(spark, lake_path, [b], log), b, known)
    return reports


def ingest(spark: SparkSession, lake_path: str, warehouse: Warehouse, feed: DataFrame,
           batch_id: int | None = None, gate: bool = True) -> IngestReport:
    from tidemark.operators import schema_gate
    batch = feed.select(*lm.LAKE_COLUMNS)
    # One pass over the input: lake door checks and the payload gate together.
    stats = lm.door_stats(batch, schema_gate.gate_aggs(warehouse.contract) if gate else [],
                          schema_gate.gate_prepare(warehouse.contract) if gate else None,
                          known=warehouse.contract.names)
    if gate:
        schema_gate.raise_if_gate_failed(stats.extra)
    res = lm.append(spark, lake_path, batch, batch_id, stats=stats, marks=warehouse.marks())
    return IngestReport(res, apply_pending(spark, lake_path, warehouse, res))
