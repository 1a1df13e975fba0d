"""Registered queries: each operator of the library bound to the driver's
tables, plus its DuckDB oracle.  ``queries()`` callables take
``(spark, sf_dir)`` and return a DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import FEED
from tidemark.operators import fold as fold_mod
from tidemark.operators import lake as lake_mod
from tidemark.operators import warehouse as wh_mod
from tidemark.plans import oracle_sql as O
from tidemark.sources import testdata as td

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


def half_sequence(feed: DataFrame) -> int:
    """Half of the highest sequence: the 'middle of history' point used by
    the time-travel bindings."""
    return int(feed.agg(F.floor(F.max("sequence") / 2)).first()[0] or 0)


def fold_feed(feed: DataFrame, mode: str = "patch") -> DataFrame:
    return wh_mod.union_tables(wh_mod.fold_tables(feed, FEED, mode))


# --- A3-A5, B3: feed -------------------------------------------------------
@query("feed_since_offset", f"""
WITH {O.FEED}
SELECT sequence, operation, table_name, primary_key, {O.json_payload('image')} AS data, captured_at
FROM feed WHERE sequence > {O.half_sequence()}""")
def feed_since_offset(spark, sf_dir):
    feed = td.events_feed(spark, sf_dir)
    return lake_mod.since(feed, half_sequence(feed))


@query("feed_latest_sequence", f"""
WITH {O.FEED}
SELECT CAST(coalesce(max(sequence), 0) AS BIGINT) AS latest_sequence FROM feed""")
def feed_latest_sequence(spark, sf_dir):
    return lake_mod.latest_sequence(td.events_feed(spark, sf_dir))


@query("feed_operation_check", """
SELECT operation, count(*) AS events, operation IN ('insert', 'update', 'delete') AS is_valid
FROM (SELECT CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete'
                             WHEN 'purchase' THEN 'update' ELSE event_type END AS operation
      FROM events) AS e
GROUP BY operation""")
def feed_operation_check(spark, sf_dir):
    # An upstream that maps only some of its codes: the rest pass through raw.
    ev = td.read(spark, sf_dir, "events")
    op = (F.when(F.col("event_type") == "signup", "insert")
          .when(F.col("event_type") == "error", "delete")
          .when(F.col("event_type") == "purchase", "update")
          .otherwise(F.col("event_type")))
    return lake_mod.operation_check(ev.select(op.alias("operation")))


# --- A10, E7, C7: warehouse fold -------------------------------------------
@query("warehouse_current", f"WITH {O.FEED} {O.fold_select('image')}")
def warehouse_current(spark, sf_dir):
    return fold_feed(td.events_feed(spark, sf_dir, "image"))


@query("warehouse_patch_fold", f"WITH {O.FEED} {O.fold_select('patch')}")
def warehouse_patch_fold(spark, sf_dir):
    return fold_feed(td.events_feed(spark, sf_dir, "patch"))


@query("warehouse_active", f"WITH {O.FEED} {O.fold_select('patch', keep_deleted=False)}")
def warehouse_active(spark, sf_dir):
    return fold_mod.active(fold_feed(td.events_feed(spark, sf_dir, "patch")))


# --- helpers for bindings that write a lake and a warehouse -----------------
def _store(spark, name: str):
    from tidemark.operators.warehouse import Warehouse
    from tidemark.session import new_work_dir
    root = new_work_dir(spark, name)
    return f"{root}/lake", Warehouse(spark, f"{root}/warehouse", FEED)


def quarter_bounds(feed: DataFrame, parts: int = 4) -> list[tuple[int, int]]:
    """Contiguous sequence ranges (lo, hi] cutting the feed into ``parts``
    micro-batches of equal sequence span, as a stream would deliver them."""
    top = int(feed.agg(F.max("sequence")).first()[0] or 0)
    cuts = [top * i // parts for i in range(parts + 1)]
    return list(zip(cuts[:-1], cuts[1:]))


def _slice(feed: DataFrame, lo: int, hi: int) -> DataFrame:
    return feed.where((F.col("sequence") > lo) & (F.col("sequence") <= hi))


def _run_batches(spark, name: str, feed: DataFrame, order: list[int]):
    from tidemark.operators.ingest import ingest
    lake_path, wh = _store(spark, name)
    bounds = quarter_bounds(feed)
    for i in order:
        ingest(spark, lake_path, wh, _slice(feed, *bounds[i]))
    return lake_path, wh, bounds


def _wh_union(wh) -> DataFrame:
    return wh_mod.union_tables({t.name: wh.read(t) for t in FEED.tables})


# --- A7/J4, L6: lake ---------------------------------------------------------
@query("lake_append_dedup", f"""
WITH {O.FEED}
SELECT sequence, operation, table_name, primary_key, {O.json_payload('image')} AS data, captured_at
FROM feed""")
def lake_append_dedup(spark, sf_dir):
    """Append the feed, then a full replay of it, then its second half again
    in one batch with every row twice: the lake holds each event once."""
    lake_path, _ = _store(spark, "lake_append_dedup")
    feed = td.events_feed(spark, sf_dir)
    lake_mod.append(spark, lake_path, feed)
    lake_mod.append(spark, lake_path, feed)
    late = lake_mod.since(feed, half_sequence(feed))
    lake_mod.append(spark, lake_path, late.unionByName(late))
    return lake_mod.read_lake(spark, lake_path).select(*lake_mod.LAKE_COLUMNS)


@query("lake_sequence_health", f"""
WITH {O.FEED}, deliveries AS (
  SELECT sequence, {O.json_payload('image')} AS data FROM feed
  UNION ALL SELECT sequence, {O.json_payload('patch')} AS data FROM feed),
per_seq AS (SELECT sequence, count(*) AS copies, count(DISTINCT data) AS versions FROM deliveries GROUP BY sequence)
SELECT CAST(sum(copies) AS BIGINT) AS events, count(*) AS distinct_sequences,
       min(sequence) AS min_sequence, max(sequence) AS max_sequence,
       count(*) FILTER (WHERE copies > 1) AS duplicate_sequences,
       count(*) FILTER (WHERE versions > 1) AS conflicting_sequences,
       max(sequence) - min(sequence) + 1 - count(*) AS missing_sequences
FROM per_seq""")
def lake_sequence_health(spark, sf_dir):
    """Health of a feed delivered twice, once as full images and once as
    patches: every sequence is duplicated, patched ones conflict."""
    both = td.events_feed(spark, sf_dir, "image").unionByName(td.events_feed(spark, sf_dir, "patch"))
    return lake_mod.sequence_health(both)


# --- J5, J2, K7, K8: warehouse over several micro-batches -------------------
@query("warehouse_apply_out_of_order", f"WITH {O.FEED} {O.fold_select('patch')}")
def warehouse_apply_out_of_order(spark, sf_dir):
    """Four micro-batches arriving newest first: every later batch is late."""
    feed = td.events_feed(spark, sf_dir, "patch")
    _, wh, _ = _run_batches(spark, "out_of_order", feed, [3, 2, 1, 0])
    return _wh_union(wh)


@query("warehouse_replay_old_batch", f"WITH {O.FEED} {O.fold_select('patch')}")
def warehouse_replay_old_batch(spark, sf_dir):
    """All batches in order, then the first and second batches again."""
    from tidemark.operators.ingest import ingest
    feed = td.events_feed(spark, sf_dir, "patch")
    lake_path, wh, bounds = _run_batches(spark, "replay", feed, [0, 1, 2, 3])
    ingest(spark, lake_path, wh, _slice(feed, bounds[0][0], bounds[1][1]))
    return _wh_union(wh)


@query("warehouse_rebuild", f"WITH {O.FEED} {O.fold_select('patch')}")
def warehouse_rebuild(spark, sf_dir):
    """K7: lake written, warehouse rebuilt from the whole lake in one fold."""
    lake_path, wh = _store(spark, "rebuild")
    lake_mod.append(spark, lake_path, td.events_feed(spark, sf_dir, "patch"))
    wh.rebuild(lake_mod.read_lake(spark, lake_path))
    return _wh_union(wh)


@query("snapshot_version_read", f"""
WITH {O.FEED}, cut AS (SELECT * FROM feed WHERE sequence <= (SELECT max(sequence) * 2 // 4 FROM feed))
{O.fold_select('patch', source='cut')}""")
def snapshot_version_read(spark, sf_dir):
    """K8: four in-order micro-batches; read each table's version 2."""
    feed = td.events_feed(spark, sf_dir, "patch")
    _, wh, _ = _run_batches(spark, "versions", feed, [0, 1, 2, 3])
    return wh_mod.union_tables({t.name: wh.read(t, version=2) for t in FEED.tables})


@query("batch_metrics", f"""
WITH {O.FEED}, top AS (SELECT max(sequence) AS m FROM feed), cuts(batch_id, lo, hi, again) AS (VALUES
  (1, 1, 2, 0), (2, 0, 1, 0), (3, 0, 2, 1), (4, 2, 4, 0)),
r AS (SELECT c.batch_id, c.again, f.table_name FROM cuts c, top, feed f
  WHERE f.sequence > top.m * c.lo // 4 AND f.sequence <= top.m * c.hi // 4)
SELECT CAST(batch_id AS BIGINT) AS batch_id, table_name, count(*) AS received,
       count(*) FILTER (WHERE again = 0) AS written, CASE WHEN batch_id = 2 THEN count(*) ELSE 0 END AS late
FROM r GROUP BY batch_id, table_name""")
def batch_metrics(spark, sf_dir):
    """Rows received, written and late per batch and table, for a batch,
    an older (late) one, both again, and the rest."""
    from tidemark.operators.ingest import ingest
    feed = td.events_feed(spark, sf_dir, "patch")
    lake_path, wh = _store(spark, "metrics")
    top = int(feed.agg(F.max("sequence")).first()[0] or 0)
    out = []
    for lo, hi in ((1, 2), (0, 1), (0, 2), (2, 4)):
        part = _slice(feed, top * lo // 4, top * hi // 4)
        rep = ingest(spark, lake_path, wh, part)
        late = {a.table: a.late for a in rep.applied}
        written = {t: v[0] for t, v in rep.append.tables.items()}
        known = spark.createDataFrame([(t.name, written.get(t.name, 0), late.get(t.name, 0)) for t in FEED.tables],
                                      "table_name string, written long, late long")
        out.append(part.groupBy("table_name").agg(F.count(F.lit(1)).alias("received")).join(known, "table_name")
                   .select(F.lit(rep.append.batch_id).cast("long").alias("batch_id"), "table_name", "received", "written", "late"))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("lake_compaction", f"""
WITH {O.FEED}
SELECT sequence, operation, table_name, primary_key, {O.json_payload('patch')} AS data, captured_at,
       (SELECT count(*) FROM feed WHERE sequence % 5 < 3) AS tail_rows
FROM feed""")
def lake_compaction(spark, sf_dir):
    """Five interleaved batches, two compactions with appends and a replay
    between them, old folders removed: every event is there once, and batches are
    still found by their id (rows of batches 1 to 3)."""
    feed = td.events_feed(spark, sf_dir, "patch")
    lake_path, _ = _store(spark, "compaction")
    for k in range(3):
        lake_mod.append(spark, lake_path, feed.where(F.col("sequence") % 5 == k))
    first = lake_mod.compact(spark, lake_path)
    lake_mod.append(spark, lake_path, feed.where(F.col("sequence") % 5 >= 2))
    lake_mod.append(spark, lake_path, feed)
    second = lake_mod.compact(spark, lake_path)
    lake_mod.vacuum(spark, lake_path)
    assert first == 1 and second == 2 and len(lake_mod.segments(spark, lake_path)) == 1
    tail = lake_mod.read_batches(spark, lake_path, [1, 2, 3]).agg(F.count(F.lit(1)).alias("n")).scalar()
    return lake_mod.read_lake(spark, lake_path).select(*lake_mod.LAKE_COLUMNS, tail.alias("tail_rows"))


@query("lake_range_read", f"""
WITH {O.FEED}
SELECT table_name, count(*) AS events, min(sequence) AS lo, max(sequence) AS hi FROM feed
WHERE sequence > {O.half_sequence()} AND sequence <= (SELECT max(sequence) * 3 // 4 FROM feed) GROUP BY table_name""")
def lake_range_read(spark, sf_dir):
    """A sequence range of a lake of four batches, from the folders it needs."""
    feed = td.events_feed(spark, sf_dir, "patch")
    lake_path, _, bounds = _run_batches(spark, "range", feed, [0, 1, 2, 3])
    rows = lake_mod.read_lake(spark, lake_path, lo=bounds[2][0] + 1, hi=bounds[2][1])
    return rows.groupBy("table_name").agg(F.count(F.lit(1)).alias("events"), F.min("sequence").alias("lo"),
                                          F.max("sequence").alias("hi"))


# --- K1-K6, K9, D7: history ----------------------------------------------------
def _per_feed_table(feed: DataFrame, fn) -> DataFrame:
    return wh_mod.union_tables({t.name: fn(feed.where(F.col("table_name") == t.name), t)
                                for t in FEED.tables})


_ASOF_COLS = "table_name, user_id, event_type, value, k, _cdc_seq"


@query("asof_sequence", f"""
WITH {O.FEED}, cut AS (SELECT * FROM feed WHERE sequence <= {O.half_sequence()})
SELECT {_ASOF_COLS} FROM ({O.fold_select('image', source='cut', keep_deleted=False)}) AS x""")
def asof_sequence(spark, sf_dir):
    """K1: state at the middle of history, whole-image replay."""
    from tidemark.operators import history
    feed = td.events_feed(spark, sf_dir, "image")
    target = half_sequence(feed)
    return _per_feed_table(feed, lambda ev, t: history.asof_sequence(ev, t, target, "image"))


@query("asof_raw", f"""
WITH {O.FEED}, cut AS (SELECT *, {O.json_payload('image')} AS data FROM feed WHERE sequence <= {O.half_sequence()}),
last AS (SELECT table_name, primary_key, arg_max(operation, sequence) AS op, arg_max(data, sequence) AS data,
                max(sequence) AS _cdc_seq FROM cut GROUP BY table_name, primary_key)
SELECT table_name, primary_key, data, _cdc_seq FROM last WHERE op <> 'delete'""")
def asof_raw(spark, sf_dir):
    """K1 over every table in the lake as raw payloads, at the middle of history."""
    from tidemark.operators import history
    feed = td.events_feed(spark, sf_dir, "image")
    return history.asof_raw(feed, half_sequence(feed))


@query("asof_timestamp", f"""
WITH {O.FEED}, cut AS (SELECT * FROM feed WHERE captured_at <=
   (SELECT captured_at FROM feed WHERE sequence = {O.half_sequence()}))
SELECT {_ASOF_COLS} FROM ({O.fold_select('patch', source='cut', keep_deleted=False)}) AS x""")
def asof_timestamp(spark, sf_dir):
    """K2: state as known at the capture time of the middle event."""
    from tidemark.operators import history
    feed = td.events_feed(spark, sf_dir, "patch")
    half = half_sequence(feed)
    ts = feed.where(F.col("sequence") == half).select("captured_at").first()[0]
    return _per_feed_table(feed, lambda ev, t: history.asof_time(ev, t, F.lit(ts), "patch"))


@query("key_history", f"""
WITH {O.FEED}
SELECT table_name, primary_key, sequence, operation, captured_at,
       row_number() OVER (PARTITION BY table_name, primary_key ORDER BY sequence) AS version_no
FROM feed""")
def key_history(spark, sf_dir):
    from tidemark.operators import history
    return history.key_history(td.events_feed(spark, sf_dir, "patch"))


@query("scd2_history", f"""
WITH {O.FEED}, {O.states_cte('patch')}
SELECT table_name, user_id, s_event_type AS event_type, s_value AS value, s_k AS k,
       sequence AS valid_from_seq, next_seq AS valid_to_seq,
       captured_at AS valid_from_ts, next_ts AS valid_to_ts, next_seq IS NULL AS is_current
FROM st WHERE operation <> 'delete'""")
def scd2_history(spark, sf_dir):
    from tidemark.operators import history
    return _per_feed_table(td.events_feed(spark, sf_dir, "patch"), history.scd2)


@query("asof_join", f"""
WITH {O.FEED}, {O.states_cte('patch')},
facts AS (SELECT sequence AS fact_sequence, table_name, primary_key FROM feed WHERE event_type = 'purchase')
SELECT f.fact_sequence, f.table_name, f.primary_key,
       CASE WHEN s.operation <> 'delete' THEN s.sequence END AS asof_sequence,
       CASE WHEN s.operation <> 'delete' THEN s.s_event_type END AS asof_event_type,
       CASE WHEN s.operation <> 'delete' THEN s.s_value END AS asof_value,
       CASE WHEN s.operation <> 'delete' THEN s.s_k END AS asof_k
FROM facts f ASOF LEFT JOIN st s
  ON f.table_name = s.table_name AND f.primary_key = s.primary_key AND f.fact_sequence > s.sequence""")
def asof_join(spark, sf_dir):
    """Every purchase with the state of its key just before it
    (NULL when the key did not exist or was deleted at that point)."""
    from tidemark.operators import history
    feed = td.events_feed(spark, sf_dir, "patch")
    facts = (td.feed_columns(td.read(spark, sf_dir, "events")).where(F.col("event_type") == "purchase")
             .select(F.col("sequence").alias("fact_sequence"), "table_name", "primary_key"))
    j = wh_mod.union_tables({t.name: history.asof_events(
        facts.where(F.col("table_name") == t.name).drop("table_name"), feed.where(F.col("table_name") == t.name), t,
        "primary_key", "fact_sequence") for t in FEED.tables})
    alive = F.col("asof_alive")
    return j.select("fact_sequence", "table_name", "primary_key", F.when(alive, F.col("asof_sequence")).alias("asof_sequence"),
                    *[F.when(alive, F.col("asof_" + c)).alias("asof_" + c) for c in ("event_type", "value", "k")])


_CUR = O.fold_select("patch", keep_deleted=False)
_TGT = O.fold_select("patch", source="cut", keep_deleted=False)
_DIFF = f"""
WITH {O.FEED}, cut AS (SELECT * FROM feed WHERE sequence <= {O.half_sequence()}),
cur AS ({_CUR}), tgt AS ({_TGT}),
d AS (
  SELECT coalesce(c.table_name, t.table_name) AS table_name, coalesce(c.user_id, t.user_id) AS user_id,
         CASE WHEN c.user_id IS NULL THEN 'added' WHEN t.user_id IS NULL THEN 'removed' ELSE 'changed' END AS change_type,
         t.event_type, t.value, t.k
  FROM {{before}} c FULL OUTER JOIN {{after}} t ON c.table_name = t.table_name AND c.user_id = t.user_id
  WHERE c.user_id IS NULL OR t.user_id IS NULL OR c.event_type IS DISTINCT FROM t.event_type
     OR c.value IS DISTINCT FROM t.value OR c.k IS DISTINCT FROM t.k)"""


def _feed_states(spark, sf_dir):
    """(as-of middle, current) active states of the patch feed, with keys."""
    from tidemark.operators import history
    feed = td.events_feed(spark, sf_dir, "patch")
    half = half_sequence(feed)
    tgt = _per_feed_table(feed, lambda ev, t: history.asof_sequence(ev, t, half, "patch"))
    cur = fold_mod.active(fold_feed(feed))
    return feed, tgt.drop("_cdc_seq"), cur.drop("_cdc_seq", "_deleted")


@query("snapshot_diff", _DIFF.format(before="tgt", after="cur") +
       " SELECT table_name, user_id, change_type FROM d")
def snapshot_diff(spark, sf_dir):
    """K5: keys added, removed or changed between the middle and the end."""
    from tidemark.operators import history
    _, tgt, cur = _feed_states(spark, sf_dir)
    return history.diff(tgt, cur, ["table_name", "user_id"], ["event_type", "value", "k"]).select(
        "table_name", "user_id", "change_type")


_ASOF_ORDER = [0, 2, 1, 3]          # the second range arrives after the third


@query("asof_from_version", f"""
WITH {O.FEED}, cut AS (SELECT * FROM feed WHERE sequence <= (SELECT max(sequence) * 7 // 8 FROM feed))
SELECT {_ASOF_COLS} FROM ({O.fold_select('patch', source='cut', keep_deleted=False)}) AS x""")
def asof_from_version(spark, sf_dir):
    """K1 from the nearest warehouse version and the batches after it, after a late batch."""
    feed = td.events_feed(spark, sf_dir, "patch")
    lake_path, wh, bounds = _run_batches(spark, "asof_version", feed, _ASOF_ORDER)
    target = bounds[3][1] * 7 // 8
    out = wh_mod.union_tables({t.name: wh.asof(t, lake_path, target) for t in FEED.tables})
    return out.select(*_ASOF_COLS.split(", "))


@query("diff_from_versions", _DIFF.format(before="tgt", after="cur") +
       " SELECT table_name, user_id, change_type FROM d")
def diff_from_versions(spark, sf_dir):
    """K5 by touched keys: both states are built for the keys with events in between only."""
    feed = td.events_feed(spark, sf_dir, "patch")
    lake_path, wh, bounds = _run_batches(spark, "diff_versions", feed, _ASOF_ORDER)
    parts = {t.name: wh.diff(t, lake_path, bounds[1][1], bounds[3][1]) for t in FEED.tables}
    return wh_mod.union_tables(parts).select("table_name", "user_id", "change_type")


@query("restore_events", _DIFF.format(before="cur", after="tgt") + f"""
SELECT table_name, CAST(user_id AS VARCHAR) AS primary_key,
       CASE change_type WHEN 'removed' THEN 'delete' WHEN 'added' THEN 'insert' ELSE 'update' END AS operation,
       (SELECT max(sequence) FROM feed) AS sequence, CAST(1 AS INTEGER) AS _restore_no,
       CASE WHEN change_type = 'removed' THEN '{{}}' ELSE {O.image_json()} END AS data
FROM d""")
def restore_events(spark, sf_dir):
    """K6: compensating events taking the current state back to the middle."""
    from tidemark.contracts import FEED as C
    from tidemark.operators import history
    feed, tgt, cur = _feed_states(spark, sf_dir)
    top = int(feed.agg(F.max("sequence")).first()[0])
    out = None
    for t in C.tables:
        ev = history.restore_events(cur.where(F.col("table_name") == t.name).drop("table_name"),
                                    tgt.where(F.col("table_name") == t.name).drop("table_name"),
                                    t, top, 1)
        out = ev if out is None else out.unionByName(ev)
    return out.drop("captured_at")


@query("current_facts", """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, CAST(o.o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
       c.c_name, n.n_name, r.r_name
FROM orders o
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def current_facts(spark, sf_dir):
    """K9: orders with their customer's current (active) dimension rows;
    customers of the BUILDING segment stand for soft-deleted rows."""
    from tidemark.operators import history
    orders = td.read(spark, sf_dir, "orders")
    cust = td.read(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "BUILDING")
    view = history.star_view(orders, [
        (cust.select("c_custkey", "c_name", "c_nationkey"), "o_custkey", "c_custkey"),
        (td.read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), "c_nationkey", "n_nationkey"),
        (td.read(spark, sf_dir, "region").select("r_regionkey", "r_name"), "n_regionkey", "r_regionkey"),
    ])
    return view.select("o_orderkey", "o_custkey", "o_orderstatus",
                       F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
                       "c_name", "n_name", "r_name")


# --- B1, B2, B4: capture -------------------------------------------------------
@query("capture_diff", _DIFF.format(before="tgt", after="cur") + f"""
SELECT CAST(row_number() OVER (ORDER BY table_name, CAST(user_id AS VARCHAR)) AS BIGINT) AS sequence,
       CASE change_type WHEN 'removed' THEN 'delete' WHEN 'added' THEN 'insert' ELSE 'update' END AS operation,
       table_name, CAST(user_id AS VARCHAR) AS primary_key,
       CASE WHEN change_type = 'removed' THEN '{{}}' ELSE {O.image_json()} END AS data
FROM d""")
def capture_diff(spark, sf_dir):
    """B1+B2: events that turn the middle-of-history snapshot into the
    current one, numbered 1.. with no gaps by (table, key)."""
    from tidemark.contracts import FEED as C
    from tidemark.operators import capture
    _, tgt, cur = _feed_states(spark, sf_dir)
    ev = None
    for t in C.tables:
        e = capture.capture_diff(tgt.where(F.col("table_name") == t.name).drop("table_name"),
                                 cur.where(F.col("table_name") == t.name).drop("table_name"), t)
        ev = e if ev is None else ev.unionByName(e)
    return capture.to_feed(ev).drop("captured_at")


@query("capture_incremental", """
SELECT o_orderkey, o_orderstatus, o_orderdate,
       max(o_orderdate) OVER () AS new_watermark
FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) - INTERVAL 365 DAY FROM orders)""")
def capture_incremental(spark, sf_dir):
    """Orders changed in the last year before the newest order date."""
    from tidemark.operators import capture
    orders = td.read(spark, sf_dir, "orders")
    watermark = orders.select(F.max("o_orderdate") - F.expr("INTERVAL 365 DAYS")).scalar()
    return capture.incremental_extract(orders, "o_orderdate", watermark).select(
        "o_orderkey", "o_orderstatus", "o_orderdate", "new_watermark")


# --- V01-V49 families, L1, L8: rules over the driver's tables ----------------------
def _testdata_tables(spark, sf_dir) -> dict[str, DataFrame]:
    from tidemark.contracts import TESTDATA
    return {t.name: td.read(spark, sf_dir, t.name) for t in TESTDATA.tables}


def _run_rules(spark, sf_dir, rule_types):
    from tidemark.contracts import TESTDATA
    from tidemark.operators import rules as R
    picked = [r for r in R.contract_rules(TESTDATA) if r.rule_type in rule_types]
    return R.evaluate(spark, picked, _testdata_tables(spark, sf_dir)).select(
        *O.RULE_COLS.split(", "))


def _contract_sql(types):
    from tidemark.contracts import TESTDATA
    return O.contract_rules_sql(TESTDATA, types)


@query("check_pk_unique", _contract_sql({"pk_unique"}))
def check_pk_unique(spark, sf_dir):
    return _run_rules(spark, sf_dir, {"pk_unique"})


@query("check_fk", _contract_sql({"fk"}))
def check_fk(spark, sf_dir):
    return _run_rules(spark, sf_dir, {"fk"})


@query("check_not_null", _contract_sql({"not_null"}))
def check_not_null(spark, sf_dir):
    return _run_rules(spark, sf_dir, {"not_null"})


@query("check_nonnegative", _contract_sql({"nonnegative"}))
def check_nonnegative(spark, sf_dir):
    return _run_rules(spark, sf_dir, {"nonnegative"})


@query("check_amount_fee", _contract_sql({"amount_fee", "positive"}))
def check_amount_fee(spark, sf_dir):
    return _run_rules(spark, sf_dir, {"amount_fee", "positive"})


@query("check_enum", _contract_sql({"enum"}))
def check_enum(spark, sf_dir):
    return _run_rules(spark, sf_dir, {"enum"})


@query("check_suite", _contract_sql(None))
def check_suite(spark, sf_dir):
    """Every rule the contract implies, fused per table."""
    from tidemark.contracts import TESTDATA
    from tidemark.operators import rules as R
    return R.evaluate(spark, R.contract_rules(TESTDATA), _testdata_tables(spark, sf_dir)).select(
        *O.RULE_COLS.split(", "))


@query("check_pk_unique_active", O.pk_sql(
    "lineitem:pk_unique_active:l_orderkey+l_linenumber", "lineitem", ["l_orderkey", "l_linenumber"],
    layer="warehouse", rule_type="pk_unique_active", where="l_returnflag <> 'R'"))
def check_pk_unique_active(spark, sf_dir):
    """V06-V10 shape: duplicate keys among active rows; returned lines
    (flag R) stand for soft-deleted rows."""
    from tidemark.operators import rules as R
    li = td.read(spark, sf_dir, "lineitem").withColumn("_deleted", F.col("l_returnflag") == "R")
    rule = R.Rule("lineitem:pk_unique_active:l_orderkey+l_linenumber", "warehouse", "lineitem",
                  "l_orderkey+l_linenumber", "pk_unique_active", "pk",
                  "{table}: primary key {column} non-uniqueness detected in active warehouse rows",
                  keys=("l_orderkey", "l_linenumber"), active_only=True)
    return R.evaluate(spark, [rule], {"lineitem": li}).select(*O.RULE_COLS.split(", "))


@query("check_fk_active", O.fk_sql(
    "orders:fk_active:o_custkey", "orders", "o_custkey", "customer", "c_custkey", layer="warehouse",
    rule_type="fk_active", parent_src="(SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING')"))
def check_fk_active(spark, sf_dir):
    """V16-V18 shape: active children whose parent is missing or deleted;
    BUILDING customers stand for soft-deleted parents."""
    from tidemark.operators import rules as R
    orders = td.read(spark, sf_dir, "orders").withColumn("_deleted", F.lit(False))
    cust = td.read(spark, sf_dir, "customer").withColumn("_deleted", F.col("c_mktsegment") == "BUILDING")
    rule = R.Rule("orders:fk_active:o_custkey", "warehouse", "orders", "o_custkey", "fk_active", "fk",
                  "{table}.{column} -> customer.c_custkey: {n} active warehouse row(s) violate referential integrity",
                  keys=("o_custkey",), parent="customer", parent_key="c_custkey",
                  active_only=True, parent_active_only=True)
    return R.evaluate(spark, [rule], {"orders": orders, "customer": cust}).select(*O.RULE_COLS.split(", "))


@query("check_time_order", O.row_sql(
    "lineitem_orders:time_order:l_shipdate", "lineitem_orders", "l_shipdate", "time_order",
    "l_shipdate < o_orderdate",
    source="(SELECT l.l_shipdate, o.o_orderdate FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"))
def check_time_order(spark, sf_dir):
    """V43/V44 shape: a line shipped before its order was placed."""
    from tidemark.operators import rules as R
    li = td.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    orders = td.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    view = li.join(orders, li.l_orderkey == orders.o_orderkey)
    rule = R.Rule("lineitem_orders:time_order:l_shipdate", "source", "lineitem_orders", "l_shipdate",
                  "time_order", "row", "{table}: {n} row(s) have a ship date before the order date",
                  predicate="l_shipdate < o_orderdate")
    return R.evaluate(spark, [rule], {"lineitem_orders": view}).select(*O.RULE_COLS.split(", "))


# --- L2-L5, L7 ---------------------------------------------------------------------
@query("check_transitions", f"""
WITH {O.FEED}, p AS (
  SELECT table_name, lag(operation) OVER (PARTITION BY table_name, primary_key ORDER BY sequence) AS from_value,
         operation AS to_value FROM feed),
allowed(from_value, to_value) AS (VALUES (NULL, 'insert'), (NULL, 'update'), (NULL, 'delete'),
  ('insert', 'update'), ('insert', 'delete'), ('update', 'update'), ('update', 'delete'),
  ('delete', 'insert'), ('delete', 'delete'))
SELECT table_name, from_value, to_value, count(*) AS violations FROM p
WHERE NOT EXISTS (SELECT 1 FROM allowed a WHERE a.from_value IS NOT DISTINCT FROM p.from_value
                  AND a.to_value = p.to_value)
GROUP BY table_name, from_value, to_value""")
def check_transitions(spark, sf_dir):
    """L2: operation sequences per key the contract does not allow
    (e.g. an insert on a live row, an update after a delete)."""
    from tidemark.operators import rules as R
    return R.transition_violations(td.events_feed(spark, sf_dir, "patch"), FEED, "operation")


@query("check_totals", """
WITH lines AS (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))
                         * (1 + CAST(l_tax AS DECIMAL(18,2)))) AS s
  FROM lineitem GROUP BY l_orderkey)
SELECT count(*) AS parents, count(s) AS parents_with_lines,
       count(*) FILTER (WHERE s IS NOT NULL AND abs(CAST(o_totalprice AS DECIMAL(18,2)) - s) > 1.00) AS mismatched,
       count(*) FILTER (WHERE s IS NULL) AS without_lines
FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey""")
def check_totals(spark, sf_dir):
    """L3: order total against the sum of its lines, within 1.00."""
    from tidemark.operators import rules as R
    dec = "decimal(18,2)"
    amount = (F.col("l_extendedprice").cast(dec) * (F.lit(1) - F.col("l_discount").cast(dec))
              * (F.lit(1) + F.col("l_tax").cast(dec)))
    return R.totals_mismatch(td.read(spark, sf_dir, "orders"), "o_orderkey", F.col("o_totalprice").cast(dec),
                             td.read(spark, sf_dir, "lineitem"), "l_orderkey", amount)


@query("check_running_balance", """
WITH e AS (SELECT user_id, event_id,
  CASE WHEN event_type IN ('purchase', 'error') THEN -1 ELSE 1 END * CAST(value AS DECIMAL(18,2)) AS amount,
  CASE WHEN event_id % 7 = 0 THEN CAST(0 AS DECIMAL(18,2)) END AS recorded FROM events),
r AS (SELECT *, sum(amount) OVER (PARTITION BY user_id ORDER BY event_id) AS balance FROM e)
SELECT user_id, count(*) AS entries, CAST(arg_max(balance, event_id) AS DECIMAL(18,2)) AS final_balance,
       CAST(min(balance) AS DECIMAL(18,2)) AS lowest_balance, count(*) FILTER (WHERE balance < 0) AS below_zero,
       count(*) FILTER (WHERE recorded IS NOT NULL AND recorded <> balance) AS differs
FROM r GROUP BY user_id""")
def check_running_balance(spark, sf_dir):
    """Running balance per user, purchases and errors as debits; every
    seventh entry records a balance of zero, which nearly always differs."""
    from tidemark.operators import rules as R
    dec = "decimal(18,2)"
    sign = F.when(F.col("event_type").isin("purchase", "error"), -1).otherwise(1)
    return R.running_balance(td.read(spark, sf_dir, "events"), "user_id", "event_id",
                             sign * F.col("value").cast(dec),
                             F.when(F.col("event_id") % 7 == 0, F.lit(0).cast(dec)))


@query("check_balance_by_time", """
WITH e AS (SELECT user_id, event_id, date_trunc('day', ts) AS day,
  CASE WHEN event_type IN ('purchase', 'error') THEN -1 ELSE 1 END * CAST(value AS DECIMAL(18,2)) AS amount FROM events),
r AS (SELECT *, sum(amount) OVER (PARTITION BY user_id ORDER BY day, event_id ROWS UNBOUNDED PRECEDING) AS balance,
             row_number() OVER (PARTITION BY user_id ORDER BY day DESC, event_id DESC) AS place FROM e)
SELECT user_id, count(*) AS entries, CAST(max(balance) FILTER (WHERE place = 1) AS DECIMAL(18,2)) AS final_balance,
       CAST(min(balance) AS DECIMAL(18,2)) AS lowest_balance, count(*) FILTER (WHERE balance < 0) AS below_zero,
       CAST(0 AS BIGINT) AS differs
FROM r GROUP BY user_id""")
def check_balance_by_time(spark, sf_dir):
    """Running balance in time order, where entries of one day tie and
    their ids decide."""
    from tidemark.operators import rules as R
    sign = F.when(F.col("event_type").isin("purchase", "error"), -1).otherwise(1)
    events = td.read(spark, sf_dir, "events").withColumn("day", F.date_trunc("day", "ts"))
    return R.running_balance(events, "user_id", ["day", "event_id"], sign * F.col("value").cast("decimal(18,2)"))


@query("check_freshness", f"""
WITH {O.FEED}
SELECT table_name, count(*) AS events, max(captured_at) AS max_captured_at,
       CAST((epoch_us((SELECT max(captured_at) FROM feed)) - epoch_us(max(captured_at))) // 1000000 AS BIGINT)
         AS lag_seconds
FROM feed GROUP BY table_name""")
def check_freshness(spark, sf_dir):
    """L4: newest change per table and how far it trails the feed."""
    from tidemark.operators import rules as R
    return R.freshness(td.events_feed(spark, sf_dir, "patch"))


@query("check_completeness", """
SELECT (SELECT count(*) FROM documents) AS source_rows, (SELECT count(*) FROM labels) AS target_rows,
       (SELECT count(*) FROM (SELECT DISTINCT doc_id FROM documents) d
         WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) AS missing_in_target,
       (SELECT count(*) FROM (SELECT DISTINCT doc_id FROM labels) l
         WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)) AS extra_in_target""")
def check_completeness(spark, sf_dir):
    """L4: labels as a downstream copy keyed by documents.doc_id."""
    from tidemark.operators import rules as R
    return R.completeness(td.read(spark, sf_dir, "documents"), td.read(spark, sf_dir, "labels"), ["doc_id"])


@query("check_lake_consistency", f"""
WITH {O.FEED}
SELECT count(*) AS warehouse_rows, count(*) AS rebuild_rows,
       CAST(0 AS BIGINT) AS only_in_warehouse, CAST(0 AS BIGINT) AS only_in_rebuild
FROM ({O.fold_select('patch')}) AS w""")
def check_lake_consistency(spark, sf_dir):
    """Warehouse built by four micro-batches equals the fold of its lake."""
    from tidemark.operators import rules as R
    feed = td.events_feed(spark, sf_dir, "patch")
    lake_path, wh, _ = _run_batches(spark, "consistency", feed, [0, 1, 2, 3])
    rebuilt = fold_feed(lake_mod.read_lake(spark, lake_path))
    return R.consistency(_wh_union(wh), rebuilt)


@query("check_consistency_ranges", f"""
WITH {O.FEED}, w AS ({O.fold_select('patch')}),
c AS (SELECT * REPLACE (CASE WHEN user_id % 17 = 3 THEN coalesce(k, 0) + 1 ELSE k END AS k) FROM w WHERE user_id % 13 <> 5
      UNION ALL SELECT * FROM w WHERE user_id % 19 = 2 AND user_id % 13 <> 5 AND user_id % 17 <> 3),
l AS (SELECT table_name, user_id, k, count(*) AS n FROM w GROUP BY ALL),
r AS (SELECT table_name, user_id, k, count(*) AS n FROM c GROUP BY ALL),
d AS (SELECT coalesce(l.table_name, r.table_name) AS table_name, coalesce(l.user_id, r.user_id) AS user_id,
             coalesce(l.n, 0) - coalesce(r.n, 0) AS more
      FROM l FULL JOIN r ON l.table_name = r.table_name AND l.user_id = r.user_id AND l.k IS NOT DISTINCT FROM r.k)
SELECT table_name, user_id, CASE WHEN more > 0 THEN 'left' ELSE 'right' END AS side, CAST(abs(more) AS BIGINT) AS copies
FROM d WHERE more <> 0""")
def check_consistency_ranges(spark, sf_dir):
    """The warehouse against a copy with rows lost, changed and doubled; only
    ranges of keys whose checksums differ are compared row by row."""
    from tidemark.operators import rules as R
    w = fold_feed(td.events_feed(spark, sf_dir, "patch"))
    u = F.col("user_id")
    copy = w.where(u % 13 != 5).withColumn("k", F.when(u % 17 == 3, F.coalesce("k", F.lit(0)) + 1).otherwise(F.col("k")).cast(w.schema["k"].dataType))
    copy = copy.unionByName(w.where((u % 19 == 2) & (u % 13 != 5) & (u % 17 != 3)))
    return R.differing_rows(w, copy, ["table_name", "user_id"]).select("table_name", "user_id", "side", "copies")


@query("quarantine_split", """
WITH r AS (
  SELECT list_filter([
      CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'enum:o_orderstatus' END,
      CASE WHEN o_totalprice <= 0 THEN 'amount_fee:o_totalprice_positive' END,
      CASE WHEN o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o_custkey)
           THEN 'fk:o_custkey' END,
      CASE WHEN o_orderkey IS NULL THEN 'not_null:o_orderkey' END,
      CASE WHEN o_custkey IS NULL THEN 'not_null:o_custkey' END,
      CASE WHEN o_orderstatus IS NULL THEN 'not_null:o_orderstatus' END,
      CASE WHEN o_totalprice IS NULL THEN 'not_null:o_totalprice' END,
      CASE WHEN o_orderdate IS NULL THEN 'not_null:o_orderdate' END,
      CASE WHEN o_orderpriority IS NULL THEN 'not_null:o_orderpriority' END], lambda x: x IS NOT NULL) AS reasons
  FROM orders)
SELECT reason, count(*) AS rows FROM (
  SELECT unnest(CASE WHEN len(reasons) = 0 THEN [NULL::VARCHAR] ELSE reasons END) AS reason FROM r) AS u
GROUP BY reason""")
def quarantine_split(spark, sf_dir):
    """Orders split into good rows and quarantined rows with reasons;
    rows per reason (NULL reason = good rows)."""
    from tidemark.contracts import TESTDATA
    from tidemark.operators import rules as R
    q = R.quarantine(td.read(spark, sf_dir, "orders"), TESTDATA.table("orders"),
                     {"customer": td.read(spark, sf_dir, "customer")})
    return (q.select(F.explode_outer("_reasons").alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("rows")))


# --- G1-G6: schema gate ----------------------------------------------------------------
def _contract_check_sql() -> str:
    from tidemark.contracts import TPCH_STANDARD
    vals = ", ".join(f"('{t.name}', '{c.name}', '{c.dtype.simpleString()}')"
                     for t in TPCH_STANDARD.tables for c in t.columns)
    parts = [f"""SELECT e.table_name, e.column_name, 'missing_column' AS problem, e.expected,
       CAST(NULL AS VARCHAR) AS actual, CAST(NULL AS BIGINT) AS rows
FROM (VALUES {vals}) AS e(table_name, column_name, expected)
WHERE NOT EXISTS (SELECT 1 FROM information_schema.columns c
                  WHERE c.table_name = e.table_name AND c.column_name = e.column_name)"""]
    for t in TPCH_STANDARD.tables:
        for c in t.columns:
            if c.domain:
                dom = ", ".join(f"'{v}'" for v in c.domain)
                parts.append(f"SELECT '{t.name}', '{c.name}', 'outside_domain', '{','.join(c.domain)}', "
                             f"CAST(NULL AS VARCHAR), count(*) FILTER (WHERE {c.name} NOT IN ({dom})) FROM {t.name}")
    return "\nUNION ALL\n".join(parts)


@query("contract_check", _contract_check_sql())
def contract_check(spark, sf_dir):
    """G1+G3: the driver's tables against the standard TPC-H column set:
    dropped columns, type changes and values outside declared domains."""
    from tidemark.contracts import TPCH_STANDARD
    from tidemark.operators import schema_gate
    return schema_gate.schema_report(_testdata_tables(spark, sf_dir), TPCH_STANDARD)


@query("payload_key_drift", f"""
WITH {O.FEED}
SELECT table_name, operation, 'value' AS key_name, 'missing_key' AS drift, count(*) AS events,
       min(sequence) AS first_sequence
FROM feed WHERE operation <> 'delete' AND event_type = 'view' GROUP BY table_name, operation""")
def payload_key_drift(spark, sf_dir):
    """Keys sent vs keys declared, on the partial-row feed."""
    from tidemark.operators import schema_gate
    return schema_gate.payload_key_drift(td.events_feed(spark, sf_dir, "patch"), FEED)


def _type_drift_sql() -> str:
    cond = "operation <> 'delete' AND event_type <> 'view' AND value >= 100"
    parts = []
    for t in ("accounts", "devices"):
        for c in ("user_id", "event_type", "value", "k"):
            if c == "value":
                parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                             f"count(*) FILTER (WHERE {cond}) AS bad_values, "
                             f"min(sequence) FILTER (WHERE {cond}) AS first_sequence FROM feed WHERE table_name = '{t}'")
            else:
                parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(0 AS BIGINT) AS bad_values, "
                             "CAST(NULL AS BIGINT) AS first_sequence")
    return f"WITH {O.FEED} " + "\nUNION ALL\n".join(parts)


@query("payload_type_drift", _type_drift_sql())
def payload_type_drift(spark, sf_dir):
    """The feed checked against a contract revision that narrowed
    ``value`` to decimal(4,2): every value from 100.00 up no longer fits."""
    from tidemark.contracts import retyped
    from tidemark.operators import schema_gate
    narrow = retyped(FEED, "value", T.DecimalType(4, 2))
    return schema_gate.payload_type_drift(td.events_feed(spark, sf_dir, "patch"), narrow)


@query("key_agreement", f"""
WITH {O.FEED}
SELECT table_name, count(*) AS upserts, CAST(0 AS BIGINT) AS mismatches, CAST(0 AS BIGINT) AS missing_key
FROM feed WHERE operation <> 'delete' GROUP BY table_name""")
def key_agreement(spark, sf_dir):
    """Payload key equals the event's primary_key on every upsert."""
    from tidemark.operators import schema_gate
    return schema_gate.key_agreement(td.events_feed(spark, sf_dir, "image"), FEED)


# --- J1-J9: streaming ------------------------------------------------------------------
def _landing(spark, feed: DataFrame, root: str, order: list[int], replay: int | None = None) -> str:
    """Drop the feed into a landing folder as files, one write per
    micro-batch range in ``order`` (plus an optional replayed range)."""
    landing = f"{root}/landing"
    bounds = quarter_bounds(feed)
    for i in order + ([replay] if replay is not None else []):
        _slice(feed, *bounds[i]).write.mode("append").parquet(landing)
    return landing


@query("stream_lake_append", f"""
WITH {O.FEED}
SELECT sequence, operation, table_name, primary_key, {O.json_payload('image')} AS data, captured_at
FROM feed""")
def stream_lake_append(spark, sf_dir):
    """A file stream (newest range first, one range replayed)
    appended to the lake in several micro-batches: each event stored once."""
    from tidemark.session import new_work_dir
    from tidemark.streaming import pipeline
    root = new_work_dir(spark, "stream_lake")
    landing = _landing(spark, td.events_feed(spark, sf_dir, "image"), root, [3, 1, 2, 0], replay=1)
    feed = pipeline.read_feed_files(spark, landing, max_files_per_trigger=4)
    pipeline.run_available(feed, f"{root}/lake", None, f"{root}/checkpoint")
    return lake_mod.read_lake(spark, f"{root}/lake").select(*lake_mod.LAKE_COLUMNS)


@query("stream_warehouse", f"WITH {O.FEED} {O.fold_select('patch')}")
def stream_warehouse(spark, sf_dir):
    """Gate -> lake -> warehouse inside foreachBatch, late and
    replayed micro-batches included; ends equal to the fold of the feed."""
    from tidemark.operators.warehouse import Warehouse
    from tidemark.session import new_work_dir
    from tidemark.streaming import pipeline
    root = new_work_dir(spark, "stream_wh")
    landing = _landing(spark, td.events_feed(spark, sf_dir, "patch"), root, [2, 3, 0, 1], replay=0)
    wh = Warehouse(spark, f"{root}/warehouse", FEED)
    feed = pipeline.read_feed_files(spark, landing, max_files_per_trigger=4)
    pipeline.run_available(feed, f"{root}/lake", wh, f"{root}/checkpoint")
    return _wh_union(wh)


@query("stream_restore_stream", f"""
WITH {O.FEED}, cut AS (SELECT * FROM feed
  WHERE sequence <= (SELECT max(sequence) // 4 FROM feed) OR sequence > {O.half_sequence()})
SELECT table_name, user_id, event_type, value, k
FROM ({O.fold_select('image', source='cut', keep_deleted=False)}) AS x""")
def stream_restore_stream(spark, sf_dir):
    """A stream brings the first half, a restore goes back to the
    first quarter, the same stream brings the second half."""
    from tidemark.operators import history
    from tidemark.operators.warehouse import Warehouse
    from tidemark.session import new_work_dir
    from tidemark.streaming import pipeline
    root = new_work_dir(spark, "stream_restore")
    feed = td.events_feed(spark, sf_dir, "image")
    half = half_sequence(feed)
    quarter = int(feed.agg(F.floor(F.max("sequence") / 4)).first()[0] or 0)
    wh = Warehouse(spark, f"{root}/warehouse", FEED)
    for part in (feed.where(F.col("sequence") <= half), feed.where(F.col("sequence") > half)):
        part.write.mode("append").parquet(f"{root}/landing")
        pipeline.run_available(pipeline.read_feed_files(spark, f"{root}/landing"), f"{root}/lake", wh,
                               f"{root}/checkpoint")
        if quarter is not None:
            history.restore(spark, f"{root}/lake", wh, quarter)
            quarter = None
    return fold_mod.active(_wh_union(wh)).select("table_name", "user_id", "event_type", "value", "k")


_BAD_FEED = f"""
WITH {O.FEED}, b AS (SELECT *, CASE WHEN operation = 'delete' THEN NULL WHEN sequence % 10 = 3 THEN 'malformed'
    WHEN sequence % 14 = 5 THEN 'operation' WHEN sequence % 22 = 7 THEN 'unknown_keys'
    WHEN sequence % 26 = 9 THEN 'pk_mismatch' END AS reason FROM feed)"""


def _bad_feed(feed: DataFrame) -> DataFrame:
    """Upserts broken in four ways, by their sequence."""
    seq, upsert = F.col("sequence"), F.col("operation") != "delete"
    kind = (F.when(~upsert, None).when(seq % 10 == 3, "malformed").when(seq % 14 == 5, "operation")
            .when(seq % 22 == 7, "unknown_keys").when(seq % 26 == 9, "pk_mismatch"))
    rows = feed.withColumn("_kind", kind)
    data = (F.when(F.col("_kind") == "malformed", F.concat(F.lit("broken "), "data"))
            .when(F.col("_kind") == "unknown_keys", F.expr("concat('{\"colour\": 1, ', substring(data, 2))")).otherwise(F.col("data")))
    return rows.select("sequence", F.when(F.col("_kind") == "operation", "upsert").otherwise(F.col("operation")).alias("operation"),
                       "table_name", F.when(F.col("_kind") == "pk_mismatch", F.concat("primary_key", F.lit("0")))
                       .otherwise(F.col("primary_key")).alias("primary_key"), data.alias("data"), "captured_at")


def _quarantine_stream(spark, sf_dir, name: str):
    from tidemark.operators.warehouse import Warehouse
    from tidemark.session import new_work_dir
    from tidemark.streaming import pipeline
    root = new_work_dir(spark, name)
    feed = td.events_feed(spark, sf_dir, "patch")
    landing = _landing(spark, _bad_feed(feed), root, [1, 0, 2, 3], replay=1)
    wh = Warehouse(spark, f"{root}/warehouse", FEED)
    pipeline.run_available(pipeline.read_feed_files(spark, landing, max_files_per_trigger=4), f"{root}/lake", wh,
                           f"{root}/checkpoint", quarantine=f"{root}/quarantine")
    return root, feed, wh


@query("stream_quarantine", _BAD_FEED + """
SELECT reason, count(*) AS events FROM b GROUP BY reason""")
def stream_quarantine(spark, sf_dir):
    """A stream with broken events, one range delivered twice: good
    events reach the lake (NULL reason), the others the quarantine, each once."""
    from tidemark.operators import quarantine as q
    root, _, _ = _quarantine_stream(spark, sf_dir, "quarantine")
    held = q.read(spark, f"{root}/quarantine").select(F.element_at("reasons", 1).alias("reason"))
    good = lake_mod.read_lake(spark, f"{root}/lake").select(F.lit(None).cast("string").alias("reason"))
    return held.unionByName(good).groupBy("reason").agg(F.count(F.lit(1)).alias("events"))


@query("stream_quarantine_release", f"WITH {O.FEED} {O.fold_select('patch')}")
def stream_quarantine_release(spark, sf_dir):
    """The events held back are repaired (from the clean feed) and replayed
    late; the warehouse ends as if nothing had been broken."""
    from tidemark.operators import quarantine as q
    from tidemark.operators.ingest import ingest
    root, feed, wh = _quarantine_stream(spark, sf_dir, "release")
    repair = lambda bad: feed.join(bad.select("sequence"), "sequence", "left_semi")
    q.release(spark, f"{root}/quarantine", repair, FEED, lambda rows: ingest(spark, f"{root}/lake", wh, rows), "repaired")
    assert not q.read(spark, f"{root}/quarantine").limit(1).count()
    return _wh_union(wh)


# --- M4, M6: catalog ---------------------------------------------------------------------
def _catalog_drift_sql() -> str:
    from tidemark.contracts import TESTDATA, TPCH_STANDARD
    pub = ", ".join(f"('{t.name}', '{c.name}', '{c.dtype.simpleString()}', {str(c.nullable).lower()})"
                    for t in TPCH_STANDARD.tables for c in t.columns)
    nulls = "\nUNION ALL\n".join(
        f"SELECT '{t.name}' AS dataset, '{c.name}' AS column_name, "
        f"count(*) FILTER (WHERE {c.name} IS NULL) AS null_rows FROM {t.name}"
        for t in TESTDATA.tables for c in t.columns if not c.nullable)
    return f"""
WITH pub(dataset, column_name, published_type, published_nullable) AS (VALUES {pub}),
act AS (SELECT table_name AS dataset, column_name,
               CASE WHEN data_type = 'BIGINT' THEN 'bigint' WHEN data_type = 'INTEGER' THEN 'int'
                    WHEN data_type = 'VARCHAR' THEN 'string' WHEN data_type = 'DOUBLE' THEN 'double'
                    WHEN data_type LIKE 'TIMESTAMP%' AND data_type NOT LIKE '%TIME ZONE%' THEN 'timestamp_ntz'
                    ELSE lower(data_type) END AS actual_type
        FROM information_schema.columns),
nulls AS ({nulls})
SELECT p.dataset, p.column_name, p.published_type, a.actual_type, p.published_nullable, n.null_rows,
       CASE WHEN a.actual_type IS NULL THEN 'missing' WHEN p.published_type <> a.actual_type THEN 'type'
            WHEN coalesce(n.null_rows, 0) > 0 THEN 'nulls' ELSE 'ok' END AS drift
FROM pub p LEFT JOIN act a ON p.dataset = a.dataset AND p.column_name = a.column_name
LEFT JOIN nulls n ON p.dataset = n.dataset AND p.column_name = n.column_name"""


@query("catalog_drift", _catalog_drift_sql())
def catalog_drift(spark, sf_dir):
    """M4: the standard TPC-H column set published as the catalog of the
    driver's tables, checked against the data (types, missing columns and a
    NULL scan of every column published as not nullable)."""
    from tidemark.contracts import TPCH_STANDARD
    from tidemark.operators import catalog
    published = spark.createDataFrame(
        [(t.name, c.name, c.dtype.simpleString(), c.nullable) for t in TPCH_STANDARD.tables for c in t.columns],
        "dataset string, column_name string, published_type string, published_nullable boolean")
    return catalog.drift(published, _testdata_tables(spark, sf_dir))


@query("catalog_profile", f"""
WITH {O.FEED}, w AS ({O.fold_select('patch')})
SELECT 'lake_cdc_events' AS dataset, 'lake' AS layer, count(*) AS rows, CAST(NULL AS BIGINT) AS active_rows,
       max(sequence) AS max_sequence, max(captured_at) AS max_captured_at FROM feed
UNION ALL
SELECT 'wh_' || table_name, 'warehouse', count(*), count(*) FILTER (WHERE NOT _deleted), max(_cdc_seq),
       CAST(NULL AS TIMESTAMP) FROM w GROUP BY table_name""")
def catalog_profile(spark, sf_dir):
    """M6: published profile of the lake and the warehouse tables."""
    from tidemark.operators import catalog
    feed = td.events_feed(spark, sf_dir, "patch")
    folded = wh_mod.fold_tables(feed, FEED)
    datasets = {"lake_cdc_events": ("lake", feed)}
    datasets.update({FEED.table(n).wh_name: ("warehouse", df) for n, df in folded.items()})
    return catalog.profile(datasets)


@query("restore_roundtrip", f"""
WITH {O.FEED}, cut AS (SELECT * FROM feed WHERE sequence <= {O.half_sequence()})
SELECT table_name, user_id, event_type, value, k
FROM ({O.fold_select('patch', source='cut', keep_deleted=False)}) AS x""")
def restore_roundtrip(spark, sf_dir):
    """K6 end to end: lake and warehouse from the whole feed, restore to the
    middle of history with compensating events, read the active warehouse."""
    from tidemark.operators import history
    from tidemark.operators.ingest import ingest
    feed = td.events_feed(spark, sf_dir, "patch")
    lake_path, wh = _store(spark, "restore")
    ingest(spark, lake_path, wh, feed)
    history.restore(spark, lake_path, wh, half_sequence(feed))
    return fold_mod.active(_wh_union(wh)).select("table_name", "user_id", "event_type", "value", "k")


@query("lake_sql_scan", f"""
WITH {O.FEED}
SELECT sequence, operation, table_name, primary_key, {O.json_payload('patch')} AS data, captured_at, _ingest_batch
FROM (SELECT *, CAST(1 AS BIGINT) AS _ingest_batch FROM feed) AS f""")
def lake_sql_scan(spark, sf_dir):
    """The lake registered as a partitioned catalog table and read
    back through Spark SQL."""
    lake_path, _ = _store(spark, "lake_sql")
    lake_mod.append(spark, lake_path, td.events_feed(spark, sf_dir, "patch"))
    # one name: a run takes the place of the one before
    spark.sql("DROP TABLE IF EXISTS lake_cdc_events_query")
    name = lake_mod.register_table(spark, lake_path, "lake_cdc_events_query")
    assert spark.catalog.tableExists(name)
    return spark.sql(f"SELECT sequence, operation, table_name, primary_key, data, captured_at, _ingest_batch "
                     f"FROM `{name}`")
