"""Quarantine of change events (L7, B3): bad events flow to a store of their own,
with their reasons, while good events go on; repaired events come back.

Layout::

    <quarantine>/batch=<id>/        bad events of one delivery, with reasons
    <quarantine>/_released/<id>.json  deliveries whose events were repaired or stored anew

A delivery is written once under its own id (stream and epoch, or a name the caller
gives), and a repeated delivery replaces its own folder, so the store is idempotent
by delivery and sequence.  Reasons are the gate's checks, an operation outside the
domain and a NULL in a lake column; tables outside the contract go to the lake as ever.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import LAKE_COLUMNS, LAKE_SCHEMA, OPERATIONS, Contract
from tidemark.operators import schema_gate
from tidemark.sources import fs

REASONS = "reasons"
SCHEMA = T.StructType([T.StructField(f.name, f.dataType, True) for f in LAKE_SCHEMA.fields]
                      + [T.StructField(REASONS, T.ArrayType(T.StringType()), True)])
RELEASED = "_released"


def judged(feed: DataFrame, contract: Contract) -> DataFrame:
    """Every event with the list of reasons to hold it back (empty: good)."""
    rows = schema_gate.gate_prepare(contract)(feed.select(*LAKE_COLUMNS))
    reasons = [F.when(F.col(c).isNull(), f"null:{c}") for c in LAKE_COLUMNS]
    reasons.append(F.when(~F.col("operation").isin(*OPERATIONS), "operation"))
    reasons += [F.when(cond, name.removeprefix("gate_")) for name, cond in schema_gate.gate_conditions(contract).items()]
    return rows.select(*LAKE_COLUMNS, F.array_compact(F.array(*reasons)).alias(REASONS))


def parted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good events, bad events with reasons) of judged rows."""
    return rows.where(F.size(REASONS) == 0).drop(REASONS), rows.where(F.size(REASONS) > 0)


def split(feed: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(good events, bad events with reasons)."""
    return parted(judged(feed, contract))


def store(bad: DataFrame, path: str, delivery: str) -> None:
    """Write a delivery's bad events; the same delivery again replaces them."""
    bad.dropDuplicates(LAKE_COLUMNS).write.mode("overwrite").parquet(f"{path}/batch={delivery}")


def _deliveries(spark: SparkSession, path: str) -> list[str]:
    done = {n[:-len(".json")] for n in fs.list_names(spark, f"{path}/{RELEASED}") if n.endswith(".json") and not n.startswith(".")}
    return sorted(n.split("=", 1)[1] for n in fs.list_names(spark, path) if n.startswith("batch=") and n.split("=", 1)[1] not in done)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Events still held back, once each (a delivery may repeat another's events)."""
    names = _deliveries(spark, path)
    if not names:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(*[f"{path}/batch={n}" for n in names]).dropDuplicates(LAKE_COLUMNS)


def release(spark: SparkSession, path: str, repair: Callable[[DataFrame], DataFrame], contract: Contract,
            accept: Callable[[DataFrame], None], name: str) -> dict:
    """Replay after repair: ``repair`` changes held events, those that are good now go
    to ``accept`` (such as an ingest; it must be idempotent), the others are stored
    again as delivery ``name``.  A crash at any step repeats it without loss."""
    held = _deliveries(spark, path)
    if not held:
        return {"released": 0, "held": 0}
    while name in held:             # what is read must not be replaced
        name += "-again"
    # kept, so that the repair runs and each payload is parsed once for all that follows
    rows = judged(repair(read(spark, path).drop(REASONS)), contract).persist()
    try:
        good, bad = parted(rows)
        counts = rows.agg(F.count_if(F.size(REASONS) == 0).alias("released"),
                          F.count_if(F.size(REASONS) > 0).alias("held")).first().asDict()
        store(bad, path, name)
        if counts["released"]:
            accept(good)
    finally:
        rows.unpersist()
    for delivery in held:
        try:
            fs.write_json_atomic(spark, f"{path}/{RELEASED}/{delivery}.json", {"into": name})
        except FileExistsError:
            pass
    return counts
