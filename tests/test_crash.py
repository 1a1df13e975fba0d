"""Crash windows, shared lakes and restores: nothing stored is lost, nothing is applied twice."""
from datetime import datetime
from decimal import Decimal

import pytest

from helpers import events, rows_by_key
from tidemark.contracts import FEED
from tidemark.operators import fold, history
from tidemark.operators import lake as lm
from tidemark.operators import schema_gate as G
from tidemark.operators.ingest import ingest, pending_batches
from tidemark.operators.warehouse import Warehouse
from tidemark.sources import fs
from tidemark.streaming import pipeline


def _row(seq, op, key, value=None):
    data = {} if op == "delete" else {"user_id": key, "event_type": "view", "value": float(value), "k": seq}
    return (seq, op, "accounts", str(key), data)


def _state(df):
    return {k: (None if r["value"] is None else float(r["value"]), r["_cdc_seq"], r["_deleted"])
            for k, r in rows_by_key(df, "user_id").items()}


def _agrees(spark, lake, wh):
    table = wh.contract.table("accounts")
    rows = lm.read_lake(spark, lake).where("table_name = 'accounts'")
    assert _state(wh.read(table)) == _state(fold.fold(rows, table))
    return _state(wh.read(table))


def _dies_before_marker(monkeypatch):
    write = fs.write_json_atomic

    def crash(spark, path, obj):
        if "/_commits/" in path and path.endswith(".json") and "lake" in path:
            raise OSError("lost before the marker")
        write(spark, path, obj)
    monkeypatch.setattr(fs, "write_json_atomic", crash)


@pytest.mark.parametrize("same", [True, False])
def test_crash_between_lake_data_and_marker(spark, work, monkeypatch, same):
    lake, wh = f"{work}/lake", Warehouse(spark, f"{work}/wh", FEED)
    first = events(spark, [_row(10, "insert", 1, 1), _row(11, "update", 1, 2)])
    with monkeypatch.context() as m:
        _dies_before_marker(m)
        with pytest.raises(OSError):
            ingest(spark, lake, wh, first)
    assert lm.read_lake(spark, lake).count() == 2 and lm.committed_batches(spark, lake) == []
    assert lm.lake_max(spark, lake) == 11          # numbering goes on after rows without a marker
    other = events(spark, [_row(5, "update", 1, 9), _row(12, "insert", 2, 3)])
    ingest(spark, lake, wh, first if same else other)
    assert pending_batches(spark, lake, wh) == []
    state = _agrees(spark, lake, wh)
    assert state[1][:2] == (2.0, 11) and (same or state[2][:2] == (3.0, 12))
    ids = [r[0] for r in lm.read_lake(spark, lake).select("_ingest_batch").distinct().collect()]
    assert len(ids) == (1 if same else 2)


def _drop(spark, landing, rows):
    events(spark, rows).coalesce(1).write.mode("append").parquet(landing)


def test_stream_restore_stream(spark, work):
    landing, lake, ckpt = f"{work}/landing", f"{work}/lake", f"{work}/ckpt"
    wh = Warehouse(spark, f"{work}/wh", FEED)
    run = lambda c: pipeline.run_available(pipeline.read_feed_files(spark, landing), lake, wh, c)
    _drop(spark, landing, [_row(1, "insert", 1, 1), _row(2, "update", 1, 2)])
    run(ckpt)
    history.restore(spark, lake, wh, 1)
    assert _state(wh.read("accounts"))[1][0] == 1.0
    _drop(spark, landing, [_row(3, "insert", 2, 3)])
    run(ckpt)
    assert _agrees(spark, lake, wh) == {1: (1.0, 2, False), 2: (3.0, 3, False)}
    _drop(spark, landing, [_row(4, "update", 2, 4)])
    run(f"{work}/ckpt-new")                        # a new checkpoint reads every file again
    state = _agrees(spark, lake, wh)
    assert state[2][:2] == (4.0, 4) and state[1][0] == 1.0
    stored = lm.read_lake(spark, lake).where("_restore_no = 0")
    assert sorted(r[0] for r in stored.select("sequence").collect()) == [1, 2, 3, 4]


def test_restore_applies_what_is_pending_first(spark, work):
    lake, wh = f"{work}/lake", Warehouse(spark, f"{work}/wh", FEED)
    ingest(spark, lake, wh, events(spark, [_row(1, "insert", 1, 1)]))
    lm.append(spark, lake, events(spark, [_row(2, "insert", 4, 4)]))        # stored, not applied
    history.restore(spark, lake, wh, 1)
    ingest(spark, lake, wh, events(spark, [_row(3, "update", 1, 7)]))
    state = _agrees(spark, lake, wh)
    assert state[4][2] is True and state[1][0] == 7.0


def test_a_batch_is_read_by_its_partition(spark, work, capsys):
    lake = f"{work}/lake"
    lm.append(spark, lake, events(spark, [_row(1, "insert", 1, 1)]))
    lm.append(spark, lake, events(spark, [_row(2, "insert", 2, 1)]))
    lm.batch_rows(lm.read_lake(spark, lake), 2).explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(_ingest_batch" in plan
    assert [r["sequence"] for r in lm.batch_rows(lm.read_lake(spark, lake), 2).collect()] == [2]


@pytest.mark.parametrize("data, what", [("not json {", "malformed"), ("[1,2]", "malformed"), ('"text"', "malformed"),
                                        ('{"event_type":"view","value":1.0,"k":1}', "missing_pk")])
def test_gate_stops_unreadable_payloads(spark, work, data, what):
    lake, wh = f"{work}/lake", Warehouse(spark, f"{work}/wh", FEED)
    bad = events(spark, [(1, "insert", "accounts", "1", data)])
    with pytest.raises(G.SchemaIncompatibilityError, match=what):
        ingest(spark, lake, wh, bad)
    with pytest.raises(G.SchemaIncompatibilityError, match=what):
        pipeline.make_batch_handler(lake, None, contract=FEED)(bad, 0)      # a stream into the lake alone
    assert lm.read_lake(spark, lake).count() == 0 and wh.read("accounts").count() == 0


def test_source_gate_stops_the_capture(spark, work):
    from pyspark.sql import functions as F

    from helpers import source_tables
    from tidemark.contracts import PAYMENTS
    from tidemark.operators import capture
    t0 = datetime(2025, 3, 1)
    clean = source_tables(spark, customers=[("c1", "A", "a@x", "active", t0, t0), ("c2", "B", "b@x", "closed", t0, t0)],
                          wallets=[("w1", "c1", Decimal("5.00"), "EUR", "active", t0, t0)])
    empty = source_tables(spark)
    lake = f"{work}/lake"
    customers, wallets = clean["customers"], clean["wallets"]
    broken = {
        "null value": {"customers": customers.withColumn("email", F.lit(None).cast("string"))},
        "outside the domain": {"customers": customers.withColumn("status", F.lit("gone"))},
        "type int": {"wallets": wallets.withColumn("currency", F.lit(1))},
        "repeats": {"customers": customers.unionByName(customers)},
        "without a row in customers": {"wallets": wallets.withColumn("customer_id", F.lit("nobody"))},
        "required column missing": {"customers": customers.drop("email")},
    }
    for what, change in broken.items():
        with pytest.raises(G.SchemaIncompatibilityError, match=what):
            capture.capture_snapshots(spark, lake, empty, {**clean, **change}, PAYMENTS)
        assert lm.read_lake(spark, lake).count() == 0
    assert capture.capture_snapshots(spark, lake, empty, clean, PAYMENTS).written == 3


def test_numbering_of_a_million_wide_rows(spark, work):
    from pyspark.sql import functions as F

    from tidemark.operators import capture
    n = 1_000_000
    rows = spark.range(n).select(F.lit("insert").alias("operation"), F.lit("accounts").alias("table_name"),
                                 F.sha2(F.col("id").cast("string"), 256).alias("primary_key"),
                                 F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("data"))
    out = capture.assign_sequence(rows, ["table_name", "primary_key"], start=1)
    got = out.agg(F.count("*"), F.countDistinct("sequence"), F.min("sequence"), F.max("sequence")).first()
    assert tuple(got) == (n, n, 1, n)
    ordered = out.select("sequence", "primary_key").where("sequence % 50000 = 0").orderBy("sequence").collect()
    assert [r[1] for r in ordered] == sorted(r[1] for r in ordered)


def test_any_missing_column_leaves_all_rules_reported(spark):
    from helpers import source_tables
    from tidemark.contracts import PAYMENTS
    from tidemark.operators import rules
    tables = source_tables(spark)
    tables |= {t.wh_name: spark.createDataFrame([], t.warehouse_struct) for t in PAYMENTS.tables}
    for table, column in (("wallets", "balance"), ("transactions", "fee"), ("wh_transactions", "settled_at"),
                          ("wh_wallets", "_deleted"), ("customers", "customer_id")):
        one = {**tables, table: tables[table].drop(column)}
        got = rules.evaluate(spark, rules.reference_rules(), one).collect()
        assert len(got) == 49 and any(r["status"] == "not_evaluated" for r in got), (table, column)


def test_unknown_tables_are_one_group(spark, work):
    lake, wh = f"{work}/lake", Warehouse(spark, f"{work}/wh", FEED)
    rows = [(k, "insert", f"other_{k}", str(k), {"x": k}) for k in range(2, 60)]
    report = ingest(spark, lake, wh, events(spark, [_row(1, "insert", 1, 1), *rows]))
    assert report.append.written == 59 and set(report.append.tables) == {"accounts"}
    assert lm.lake_max(spark, lake) == 59 and _agrees(spark, lake, wh)[1][0] == 1.0
