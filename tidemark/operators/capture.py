"""Change capture from snapshots.

``capture_diff`` compares two states of a table (full outer join on the
key, null-safe column compare) and emits insert / update / delete events
whose payload is the new row image.  ``assign_sequence`` numbers events
1, 2, 3... with no gaps, in a given order, without moving all rows into one
partition: rows are range-partitioned and sorted by the order, each row
gets its position inside its partition, and per-partition counts (one row
per partition) give the offsets.  The placed rows are written once and both
the rows and the counts are read from there: range boundaries come from a
sample, so two runs of the same plan may place rows differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contracts import LAKE_COLUMNS, TableContract
from tidemark.functions import payload
from tidemark.operators import fold as fm
from tidemark.session import new_work_dir

_LOCAL_BITS = 33  # monotonically_increasing_id(): partition id << 33 | row index


def assign_sequence(df: DataFrame, order: list[str], start: int = 1, out: str = "sequence",
                    partitions: int | None = None) -> DataFrame:
    """Gapless numbering from ``start`` in ``order`` (order keys must be unique)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = (ranged.withColumn("_part", F.shiftright("_mid", _LOCAL_BITS))
              .withColumn("_local", F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1)))
    path = new_work_dir(df.sparkSession, "numbering")
    ranged.write.parquet(path)
    ranged = df.sparkSession.read.schema(ranged.schema).parquet(path)
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: bounded by the partition count, safe to broadcast.
    offsets = F.broadcast(counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_off"))
    return (ranged.join(offsets, "_part")
            .withColumn(out, (F.lit(start) + F.col("_off") + F.col("_local")).cast("long"))
            .drop("_mid", "_part", "_local", "_off"))


def capture_diff(before: DataFrame, after: DataFrame, table: TableContract) -> DataFrame:
    """B1: events turning ``before`` into ``after`` (both: contract columns).
    Columns: operation, table_name, primary_key, data (no sequence yet)."""
    pk = table.single_pk
    cols = fm.value_columns(table)
    b = before.select(pk, F.struct(*cols).alias("_b"))
    a = after.select(pk, F.struct(*cols).alias("_a"), *[F.col(c).alias(f"_a_{c}") for c in cols])
    j = b.join(a, pk, "full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & F.col("_b").getField(c).eqNullSafe(F.col("_a").getField(c))
    op = (F.when(F.col("_a").isNull(), "delete").when(F.col("_b").isNull(), "insert")
          .when(~same, "update"))
    image = payload.encode(F.col(pk), *[F.col(f"_a_{c}").alias(c) for c in cols])
    return j.select(
        op.alias("operation"),
        F.lit(table.name).alias("table_name"),
        F.col(pk).cast("string").alias("primary_key"),
        F.when(op == "delete", F.lit("{}")).otherwise(image).alias("data"),
    ).where(F.col("operation").isNotNull())


def to_feed(events: DataFrame, start: int = 1, captured_at=None) -> DataFrame:
    """B2: number captured events (by table, key) and stamp capture time."""
    ts = captured_at if captured_at is not None else F.localtimestamp()
    numbered = assign_sequence(events, ["table_name", "primary_key"], start)
    return numbered.withColumn("captured_at", ts).select(*LAKE_COLUMNS)


def incremental_extract(df: DataFrame, version_col: str, watermark) -> DataFrame:
    """Rows changed after ``watermark`` by a version/timestamp column,
    with the new watermark (max version seen) on every row.  Cannot see
    deletes, which is why snapshot diff or a log feed is the default."""
    rows = df.where(F.col(version_col) > watermark)
    # Scalar subquery (a global max is a partial + final aggregate), not an
    # unpartitioned window that would pull every row into one task.
    return rows.withColumn("new_watermark", rows.select(F.max(version_col)).scalar())


def capture_snapshots(spark, lake_path: str, before: dict[str, DataFrame], after: dict[str, DataFrame],
                      contract, captured_at=None, gate: bool = True):
    """B1+B2 into the lake: diff every contract table's two snapshots, number
    the events after the lake's highest sequence (gapless, by table and key)
    and append them.  Returns the append result.  Sources that break the
    contract stop the capture before anything is written (``gate``)."""
    from tidemark.operators import lake as lm
    from tidemark.operators import schema_gate
    if gate:
        for side in (before, after):
            schema_gate.assert_source_compatible(side, contract, names=[n for n in contract.names if n in side])
    events = None
    for t in contract.tables:
        if t.name not in before and t.name not in after:
            continue
        empty = spark.createDataFrame([], t.struct)
        d = capture_diff(before.get(t.name, empty), after.get(t.name, empty), t)
        events = d if events is None else events.unionByName(d)
    if events is None:
        return None
    feed = to_feed(events, start=lm.lake_max(spark, lake_path) + 1, captured_at=captured_at)
    return lm.append(spark, lake_path, feed)
