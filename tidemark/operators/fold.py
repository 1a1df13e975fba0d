"""Order-insensitive fold of change events into current-state rows.

For one (table, primary key), with E = its events (deduplicated) and U = the
non-delete events among them:

* the row exists iff U is not empty;
* column c = value of c in the U event with the greatest order key whose
  payload HAS key c (an explicit JSON null is a value); NULL if none;
* ``_cdc_seq`` = max sequence over E;
* ``_deleted`` = the event with the greatest order key is a delete;
* the key column = the event's ``primary_key``.

``mode="image"`` instead takes every column from the last upsert (absent key
= NULL), which is what a reader replaying whole-image payloads sees.

The fold is a single ``groupBy(key).agg(max_by(...))``: partial aggregation
collapses each key inside every map task before the shuffle, so a key holding
a large share of all events never lands as raw rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import CDC_SEQ, DELETED, RESTORE_NO, TableContract
from tidemark.functions import payload

# Internal column names of the "event form" both the lake and a prior
# warehouse snapshot are brought into before folding.
PK, SEQ, RNO, ORD, UP, DEL, BASE = "_pk", "_seq", "_rno", "_ord", "_up", "_del", "_base"


def has(name: str) -> str:
    return f"_has_{name}"


def order_key(df: DataFrame) -> Column:
    """Total order of lake rows: sequence, then restore number (restore rows
    share the sequence they were cut at, and sort after the source row)."""
    restore = F.col(RESTORE_NO) if RESTORE_NO in df.columns else F.lit(0)
    return F.struct(F.col("sequence").alias("s"), restore.cast("int").alias("r"))


def value_columns(table: TableContract) -> list[str]:
    return [c for c in table.column_names if c not in table.pk]


def event_form(events: DataFrame, table: TableContract, keep: tuple[str, ...] = ()) -> DataFrame:
    """Lake rows of one table -> typed values plus key-presence flags.
    ``keep`` names lake columns to carry along unchanged."""
    restore = F.col(RESTORE_NO) if RESTORE_NO in events.columns else F.lit(0)
    parsed = events.select(
        *[F.col(c) for c in keep],
        F.col("primary_key").alias(PK),
        F.col("sequence").alias(SEQ),
        restore.cast("int").alias(RNO),
        order_key(events).alias(ORD),
        (F.col("operation") != "delete").alias(UP),
        (F.col("operation") == "delete").alias(DEL),
        F.lit(False).alias(BASE),
        payload.typed("data", table).alias("_p"),
        payload.keys("data").alias("_k"),
    )
    cols = [*keep, PK, SEQ, RNO, ORD, UP, DEL, BASE]
    for name in value_columns(table):
        cols.append(payload.value_of(F.col("_p"), table, name).alias(name))
        cols.append(payload.has_key(F.col("_k"), name).alias(has(name)))
    return parsed.select(*cols)


def snapshot_event_form(snapshot: DataFrame, table: TableContract) -> DataFrame:
    """A warehouse snapshot row as one event that carries its whole state.
    It sorts before any event with a larger sequence."""
    pk = table.single_pk
    cols = [
        F.col(pk).cast("string").alias(PK),
        F.col(CDC_SEQ).alias(SEQ),
        F.lit(-1).alias(RNO),
        F.struct(F.col(CDC_SEQ).alias("s"), F.lit(-1).alias("r")).alias(ORD),
        F.lit(True).alias(UP),
        F.col(DELETED).alias(DEL),
        F.lit(True).alias(BASE),
    ]
    for name in value_columns(table):
        cols.append(F.col(name))
        cols.append(F.lit(True).alias(has(name)))
    return snapshot.select(*cols)


def fold_event_form(ev: DataFrame, table: TableContract, mode: str = "patch") -> DataFrame:
    """Fold event-form rows (see ``event_form``) into one row per key."""
    if mode not in ("patch", "image"):
        raise ValueError(f"unknown fold mode {mode!r}")
    up_ord = F.when(F.col(UP), F.col(ORD))
    aggs = []
    for name in value_columns(table):
        ordering = F.when(F.col(UP) & F.col(has(name)), F.col(ORD)) if mode == "patch" else up_ord
        aggs.append(F.max_by(F.col(name), ordering).alias(name))
    aggs += [
        F.max(SEQ).alias(CDC_SEQ),
        F.max_by(F.col(DEL), F.col(ORD)).alias(DELETED),
        F.max(F.col(UP).cast("int")).alias("_exists"),
    ]
    pk = table.single_pk
    pk_type = table.column(pk).dtype
    folded = ev.groupBy(PK).agg(*aggs).where(F.col("_exists") == 1)
    out_cols = []
    for name in table.column_names:
        if name == pk:
            out_cols.append(F.col(PK).cast(pk_type).alias(pk))
        else:
            out_cols.append(F.col(name))
    out_cols += [F.col(CDC_SEQ), F.col(DELETED)]
    return folded.select(*out_cols)


def fold(events: DataFrame, table: TableContract, mode: str = "patch") -> DataFrame:
    """Lake rows of ONE table -> warehouse rows (typed, with ``_cdc_seq``/``_deleted``)."""
    return fold_event_form(event_form(events, table), table, mode)


def active(wh: DataFrame) -> DataFrame:
    """Current-state view: rows that are not soft-deleted."""
    return wh.where(~F.col(DELETED))
