"""Bindings of the driver's test tables to the library's data model.

``events`` is a natural change log (``event_id`` gapless, ``ts`` ordered by
it).  It becomes a change feed over two entity tables keyed by ``user_id``:

* sequence    = event_id + 1
* operation   = signup -> insert, error -> delete, anything else -> update
* table_name  = accounts for even user_id, devices for odd
* primary_key = user_id as text
* data        = JSON of user_id, event_type, value (decimal(18,2)), k (from props);
                deletes carry ``{}``
* captured_at = ts

The *patch* variant models an upstream that sends partial rows: ``view``
events carry no ``value`` key and ``click`` events send ``"k": null``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import LAKE_COLUMNS, MONEY
from tidemark.functions import payload

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def operation_of(event_type: F.Column) -> F.Column:
    return (F.when(event_type == "signup", "insert")
            .when(event_type == "error", "delete")
            .otherwise("update"))


def table_of(user_id: F.Column) -> F.Column:
    return F.when(F.pmod(user_id, F.lit(2)) == 0, "accounts").otherwise("devices")


def feed_columns(events: DataFrame) -> DataFrame:
    """events -> typed feed columns (before JSON encoding)."""
    return events.select(
        (F.col("event_id") + 1).alias("sequence"),
        operation_of(F.col("event_type")).alias("operation"),
        table_of(F.col("user_id")).alias("table_name"),
        F.col("user_id").cast("string").alias("primary_key"),
        F.col("ts").alias("captured_at"),
        F.col("user_id"),
        F.col("event_type"),
        F.col("value").cast(MONEY).alias("value"),
        F.from_json("props", "k BIGINT").getField("k").alias("k"),
    )


def encode_feed(cols: DataFrame, variant: str = "image") -> DataFrame:
    """Typed feed columns -> lake rows with JSON payloads."""
    full = payload.encode("user_id", "event_type", "value", "k")
    if variant == "image":
        data = full
    elif variant == "patch":
        k = F.when(F.col("event_type") == "click", F.lit(None).cast("long")).otherwise(F.col("k"))
        data = (F.when(F.col("event_type") == "view", payload.encode("user_id", "event_type", k.alias("k")))
                .otherwise(payload.encode("user_id", "event_type", "value", k.alias("k"))))
    else:
        raise ValueError(f"unknown feed variant {variant!r}")
    data = F.when(F.col("operation") == "delete", F.lit("{}")).otherwise(data)
    return cols.withColumn("data", data).select(*LAKE_COLUMNS)


def events_feed(spark: SparkSession, sf_dir: str, variant: str = "image") -> DataFrame:
    """The canonical change feed derived from ``events``."""
    return encode_feed(feed_columns(read(spark, sf_dir, "events")), variant)
