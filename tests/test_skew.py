"""Correctness under skew: one key carries a third of all events and the
per-key scans are forced to cut it into many chunks; results must equal
DuckDB's plain window / ASOF JOIN over the same rows."""
import duckdb
from pyspark.sql import functions as F

from tidemark.contracts import FEED
from tidemark.operators import fold as fm
from tidemark.operators import history
from tidemark.plans import oracle_sql as O
from tidemark.plans import queries as Q
from tidemark.sources import testdata as td

SF = "/root/testdata/sf0.001"
CHUNKS = 48  # the hot key spans about a third of them


def _hot_feed(spark):
    ev = td.read(spark, SF, "events")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    return td.encode_feed(td.feed_columns(hot), "patch")


def _duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END "
                f"AS user_id, event_type, value, props FROM read_parquet('{SF}/events.parquet')")
    return con


def _rows(df, cols):
    return sorted((tuple(float(v) if hasattr(v, "as_tuple") else v for v in r) for r in df.select(*cols).collect()),
                  key=repr)


def test_scd2_and_asof_join_on_hot_key(spark):
    feed = _hot_feed(spark)
    cols = ["table_name", "user_id", "event_type", "value", "k", "valid_from_seq", "valid_to_seq", "is_current"]
    got = Q._per_feed_table(feed, lambda ev, t: history.scd2(ev, t, chunks=CHUNKS))
    sql = (f"WITH {O.FEED}, {O.states_cte('patch')} SELECT table_name, user_id, s_event_type, "
           f"CAST(s_value AS DOUBLE), s_k, sequence, next_seq, next_seq IS NULL FROM st WHERE operation <> 'delete'")
    want = sorted((tuple(r) for r in _duck().execute(sql).fetchall()), key=repr)
    assert _rows(got, cols) == want
    assert got.where("user_id = 0").count() > 200

    facts = (td.feed_columns(td.read(spark, SF, "events")
                             .withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0))
                                         .otherwise(F.col("user_id"))))
             .where(F.col("event_type") == "purchase")
             .select(F.col("sequence").alias("fact_sequence"), "table_name", "primary_key"))
    states = Q._per_feed_table(feed, lambda ev, t: history.event_states(ev, t, chunks=CHUNKS)).withColumnRenamed(
        fm.PK, "primary_key")
    j = history.asof_join(facts, states, ["table_name", "primary_key"], "fact_sequence", fm.SEQ,
                          [fm.SEQ, fm.UP, "k"], chunks=CHUNKS)
    got_j = sorted(((r.fact_sequence, r.primary_key, r["asof_" + fm.SEQ] if r["asof_" + fm.UP] else None,
                    r.asof_k if r["asof_" + fm.UP] else None) for r in j.collect()), key=repr)
    sql_j = (f"WITH {O.FEED}, {O.states_cte('patch')}, facts AS (SELECT sequence AS fs, table_name, primary_key "
             f"FROM feed WHERE event_type = 'purchase') SELECT f.fs, f.primary_key, "
             f"CASE WHEN s.operation <> 'delete' THEN s.sequence END, CASE WHEN s.operation <> 'delete' THEN s.s_k END "
             f"FROM facts f ASOF LEFT JOIN st s ON f.table_name = s.table_name AND f.primary_key = s.primary_key "
             f"AND f.fs > s.sequence")
    assert got_j == sorted((tuple(r) for r in _duck().execute(sql_j).fetchall()), key=repr)


def test_fold_on_hot_key(spark):
    feed = _hot_feed(spark)
    got = Q.fold_feed(feed)
    sql = f"WITH {O.FEED} SELECT table_name, user_id, event_type, CAST(value AS DOUBLE), k, _cdc_seq, _deleted FROM ({O.fold_select('patch')}) x"
    want = sorted((tuple(r) for r in _duck().execute(sql).fetchall()), key=repr)
    assert _rows(got, ["table_name", "user_id", "event_type", "value", "k", "_cdc_seq", "_deleted"]) == want
    assert FEED.table("accounts").single_pk == "user_id"
