"""Time travel, history and restore over the lake.

All of these are folds or per-key scans over lake rows; none needs the
warehouse.  Per-key ordered work goes through ``tidemark.functions.scan`` so
one very active key does not become one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import CDC_SEQ, DELETED, RESTORE_NO, TableContract
from tidemark.functions import payload, scan
from tidemark.functions.joins import left_spread
from tidemark.operators import fold as fm


def before_point(lake: DataFrame, target) -> DataFrame:
    """Lake rows visible 'as of sequence target': everything up to it, but
    not compensating rows cut *at* it (a restore at M lands after M)."""
    cond = F.col("sequence") <= target
    if RESTORE_NO in lake.columns:
        cond = (F.col("sequence") < target) | ((F.col("sequence") == target) & (F.col(RESTORE_NO) == 0))
    return lake.where(cond)


def asof_sequence(events: DataFrame, table: TableContract, target, mode: str = "image") -> DataFrame:
    """K1: active rows as of ``sequence <= target`` with ``_cdc_seq``.
    ``image`` mode replays whole payloads (the last event wins outright)."""
    folded = fm.fold(before_point(events, target), table, mode)
    return fm.active(folded).drop(DELETED)


def asof_raw(lake: DataFrame, target) -> DataFrame:
    """K1 for every table in the lake, including tables outside any contract:
    the last event per (table, key) at or before ``target``, deletes
    dropped, the payload as stored JSON text (what a reader replaying whole
    payloads sees).  One aggregation, partial per map task."""
    ev = before_point(lake, target)
    last = F.max_by(F.struct("operation", "data"), fm.order_key(ev))
    return (ev.groupBy("table_name", "primary_key")
            .agg(last.alias("_l"), F.max("sequence").alias(CDC_SEQ))
            .where(F.col("_l.operation") != "delete")
            .select("table_name", "primary_key", F.col("_l.data").alias("data"), CDC_SEQ))


def asof_time(events: DataFrame, table: TableContract, ts, mode: str = "patch") -> DataFrame:
    """K2: state as known at capture time ``ts``; still folded by sequence."""
    return fm.active(fm.fold(events.where(F.col("captured_at") <= ts), table, mode)).drop(DELETED)


def key_history(events: DataFrame, chunks: int | None = None) -> DataFrame:
    """K3: every event of every key, numbered in sequence order per key."""
    ev = events.select("table_name", "primary_key", "sequence", "operation", "captured_at")
    return scan.row_number(ev, ["table_name", "primary_key"], ["sequence"], "version_no", chunks)


def _states(events: DataFrame, table: TableContract, nxt=None, chunks: int | None = None) -> DataFrame:
    ev = fm.event_form(events, table, keep=("captured_at",))
    values = {n: (F.col(n), F.col(fm.UP) & F.col(fm.has(n))) for n in fm.value_columns(table)}
    return scan.over(ev, [fm.PK], [fm.SEQ, fm.RNO], last=values, nxt=nxt, chunks=chunks)


def event_states(events: DataFrame, table: TableContract, chunks: int | None = None) -> DataFrame:
    """Per event: the row state right after it (patch semantics: running last
    present value per column, carried across deletes) and whether the row is
    alive.  Columns: _pk, _seq, _rno, _up, captured_at, <value columns>."""
    return _states(events, table, chunks=chunks).select(
        fm.PK, fm.SEQ, fm.RNO, fm.UP, "captured_at", *fm.value_columns(table))


def _typed_pk(table: TableContract) -> Column:
    pk = table.single_pk
    return F.col(fm.PK).cast(table.column(pk).dtype).alias(pk)


def scd2(events: DataFrame, table: TableContract, chunks: int | None = None) -> DataFrame:
    """K4: one row per version.  A version starts at each upsert and ends at
    the key's next event (update or delete); the open version is current.
    States and next events come from one scan."""
    nb = _states(events, table, ("_nx", [fm.SEQ, "captured_at"]), chunks)
    return nb.where(F.col(fm.UP)).select(
        _typed_pk(table),
        *fm.value_columns(table),
        F.col(fm.SEQ).alias("valid_from_seq"),
        F.col("_nx").getField(fm.SEQ).alias("valid_to_seq"),
        F.col("captured_at").alias("valid_from_ts"),
        F.col("_nx").getField("captured_at").alias("valid_to_ts"),
        F.col("_nx").isNull().alias("is_current"),
    )


def asof_join(facts: DataFrame, states: DataFrame, keys: list[str], fact_seq: str, state_seq: str,
              state_cols: list[str], strict: bool = True, prefix: str = "asof_",
              chunks: int | None = None) -> DataFrame:
    """Each fact row with the latest state row of the same key at or
    before it (``strict``: strictly before).  Implemented as one ordered
    scan over facts and states together, so the key equality never pairs
    every fact with every version of a busy key."""
    fact_struct = F.struct(*[F.col(c) for c in facts.columns])
    state_struct = F.struct(*[F.col(c) for c in state_cols])
    f = facts.select(*[F.col(k) for k in keys], F.col(fact_seq).alias("_aseq"),
                     F.lit(0 if strict else 1).alias("_tie"), fact_struct.alias("_fact"))
    s = states.select(*[F.col(k) for k in keys], F.col(state_seq).alias("_aseq"),
                      F.lit(1 if strict else 0).alias("_tie"), state_struct.alias("_state"))
    u = f.unionByName(s, allowMissingColumns=True)
    r = scan.running_last(u, keys, ["_aseq", "_tie"],
                          {"_match": (F.col("_state"), F.col("_state").isNotNull())}, chunks)
    return r.where(F.col("_fact").isNotNull()).select(
        "_fact.*", *[F.col("_match").getField(c).alias(prefix + c) for c in state_cols])


def asof_events(facts: DataFrame, events: DataFrame, table: TableContract, key: str, fact_seq: str,
                strict: bool = True, prefix: str = "asof_", chunks: int | None = None) -> DataFrame:
    """D7 against a table's change events: each fact with the state of its key (lake
    form, column ``key``) that the events up to it (``strict``: before it) make.
    Facts and events are dealt together, so states and matches come from one scan.
    Adds the state's sequence, whether the row is alive, and the value columns."""
    values = fm.value_columns(table)
    ev = fm.event_form(events, table).select(
        fm.PK, F.col(fm.SEQ).alias("_aseq"), F.lit(1 if strict else 0).alias("_tie"), F.col(fm.RNO).alias("_ano"),
        fm.UP, *[F.col(n) for n in values], *[fm.has(n) for n in values])
    fact = facts.select(F.col(key).alias(fm.PK), F.col(fact_seq).alias("_aseq"), F.lit(0 if strict else 1).alias("_tie"),
                        F.lit(0).alias("_ano"), F.struct(*[F.col(c) for c in facts.columns]).alias("_fact"))
    both = ev.unionByName(fact, allowMissingColumns=True)
    event = F.col("_fact").isNull()
    last = {n: (F.col(n), event & F.col(fm.UP) & F.col(fm.has(n))) for n in values}
    last |= {"_mseq": (F.col("_aseq"), event), "_malive": (F.col(fm.UP), event)}
    r = scan.over(both, [fm.PK], ["_aseq", "_tie", "_ano"], last=last, chunks=chunks)
    return r.where(F.col("_fact").isNotNull()).select(
        "_fact.*", F.col("_mseq").alias(prefix + "sequence"), F.coalesce("_malive", F.lit(False)).alias(prefix + "alive"),
        *[F.col(n).alias(prefix + n) for n in values])


def diff(before: DataFrame, after: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """K5: keys added, removed or changed (null-safe) between two states."""
    b = before.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in cols], F.lit(True).alias("_in_b"))
    a = after.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in cols], F.lit(True).alias("_in_a"))
    j = b.join(a, keys, "full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"_b_{c}").eqNullSafe(F.col(f"_a_{c}"))
    change = (F.when(F.col("_in_b").isNull(), "added")
              .when(F.col("_in_a").isNull(), "removed")
              .when(~same, "changed"))
    return j.select(*keys, change.alias("change_type"), *[F.col(f"_b_{c}") for c in cols],
                    *[F.col(f"_a_{c}") for c in cols]).where(F.col("change_type").isNotNull())


def restore_events(current: DataFrame, target: DataFrame, table: TableContract, at_sequence,
                   restore_no: int, captured_at: Column | None = None) -> DataFrame:
    """K6: compensating lake rows that turn the active ``current`` rows into
    the active ``target`` rows.  Every row carries ``sequence = at_sequence``
    (the lake's highest sequence when the restore is cut) and
    ``restore_no``, so it never takes a number the source will issue later.
    Upserts carry the full image with explicit NULLs."""
    pk = table.single_pk
    cols = fm.value_columns(table)
    d = diff(current, target, [pk], cols)
    image = payload.encode(F.col(pk), *[F.col(f"_a_{c}").alias(c) for c in cols])
    op = (F.when(F.col("change_type") == "removed", "delete")
          .when(F.col("change_type") == "added", "insert").otherwise("update"))
    return d.select(
        F.lit(at_sequence).cast("long").alias("sequence"),
        op.alias("operation"),
        F.lit(table.name).alias("table_name"),
        F.col(pk).cast("string").alias("primary_key"),
        F.when(op == "delete", F.lit("{}")).otherwise(image).alias("data"),
        (captured_at if captured_at is not None else F.localtimestamp()).alias("captured_at"),
        F.lit(restore_no).cast("int").alias(RESTORE_NO),
    )


def restore(spark: SparkSession, lake_path: str, warehouse, target_sequence: int) -> dict:
    """K6 end to end: cut compensating events for every table, append them to
    the lake as one restore, apply them.  History is never rewritten.

    Batches that are in the lake but not applied yet are applied first, so the
    events are cut from the state that the lake stands for and no batch can
    undo the restore afterwards."""
    from tidemark.operators import lake as lm
    from tidemark.operators.ingest import apply_pending

    apply_pending(spark, lake_path, warehouse)
    lake = lm.read_lake(spark, lake_path)
    at_seq = lm.lake_max(spark, lake_path)
    # compensating rows share the sequence they were cut at
    restore_no = int(lake.agg(F.max(RESTORE_NO)).first()[0] or 0) + 1
    rows = None
    for table in warehouse.contract.tables:
        # keys without an event since the target are as they were
        keys = warehouse.touched(table, lake_path, target_sequence)
        target = warehouse.state_from(table, lake_path, warehouse.version_below(table, target_sequence), keys, target_sequence)
        current = warehouse.read(table).join(warehouse.typed_keys(table, keys), table.single_pk, "left_semi")
        ev = restore_events(fm.active(current).drop(CDC_SEQ, DELETED), fm.active(target).drop(CDC_SEQ, DELETED),
                            table, at_seq, restore_no)
        rows = ev if rows is None else rows.unionByName(ev)
    res = lm.append_restore(spark, lake_path, rows, restore_no)
    reports = apply_pending(spark, lake_path, warehouse, res)
    return {"restore_no": restore_no, "sequence": at_seq, "events": res.written, "reports": reports}


def star_view(fact: DataFrame, dims: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """K9: current-state fact view: the fact joined (left) to each dimension's
    active rows.  ``dims``: (active dimension rows, fact column, dim column).
    Each dimension join is an equi join that AQE plans by runtime size; facts
    without a key do not meet in one task."""
    out = fact
    for dim, fact_col, dim_col in dims:
        out = left_spread(out, dim, fact_col, dim_col)
    return out
