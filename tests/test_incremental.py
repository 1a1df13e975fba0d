"""Work in proportion to the change: base plus changes, ranges of the lake, tails of history, compaction."""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import events, rows_by_key
from tidemark.contracts import LONG, STR, Contract, TableContract, _c
from tidemark.functions import scan
from tidemark.operators import fold as fm
from tidemark.operators import history
from tidemark.operators import lake as lm
from tidemark.operators import warehouse as wm
from tidemark.operators.ingest import ingest
from tidemark.operators.warehouse import Warehouse
from tidemark.sources import fs

ITEMS = Contract(name="items", tables=(
    TableContract("items", (_c("id", LONG, False), _c("a", LONG), _c("b", STR)), pk=("id",)),))
TABLE = ITEMS.table("items")


def _items(spark, rows):
    return events(spark, [(s, op, "items", str(k), d) for s, op, k, d in rows])


def _filled(spark, work, keys=200):
    lake, wh = f"{work}/lake", Warehouse(spark, f"{work}/wh", ITEMS)
    ingest(spark, lake, wh, _items(spark, [(k, "insert", k, {"id": k, "a": k, "b": "x"}) for k in range(1, keys + 1)]))
    return lake, wh


def _equal_to_fold(spark, lake, wh):
    want = rows_by_key(fm.fold(lm.read_lake(spark, lake).where("table_name = 'items'"), TABLE), "id")
    assert rows_by_key(wh.read("items"), "id") == want


def test_a_batch_writes_the_rows_it_touches(spark, work):
    lake, wh = _filled(spark, work)
    rep = ingest(spark, lake, wh, _items(spark, [(300 + k, "update", k, {"id": k, "a": -k}) for k in (3, 5, 900)]))
    assert (rep.applied[0].path, rep.applied[0].written) == ("fast", 3)
    late = ingest(spark, lake, wh, _items(spark, [(290, "update", 7, {"id": 7, "b": "late"}), (2000, "delete", 3, {})]))
    assert (late.applied[0].path, late.applied[0].written) == ("mixed", 2)
    meta = wh.current_meta(TABLE)
    assert len(meta["deltas"]) == 2 and meta["base_rows"] == 200 and meta["delta_rows"] == 5
    _equal_to_fold(spark, lake, wh)
    before = rows_by_key(wh.read("items"), "id")
    assert wh.compact(TABLE) == 4 and wh.compact(TABLE) is None
    assert rows_by_key(wh.read("items"), "id") == before and wh.current_meta(TABLE)["deltas"] == []
    assert rows_by_key(wh.read("items", version=2), "id")[3]["a"] == -3
    with pytest.raises(KeyError):
        wh.read("items", version=9)


def test_changes_are_folded_into_a_new_base_in_time(spark, work, monkeypatch):
    lake, wh = _filled(spark, work, keys=4)
    kinds = []
    for k in range(6):
        ingest(spark, lake, wh, _items(spark, [(100 + 2 * k, "update", 1, {"id": 1, "a": k}), (101 + 2 * k, "update", 2, {"id": 2})]))
        kinds.append(len(wh.current_meta(TABLE)["deltas"]))
    assert kinds == [1, 2, 0, 1, 2, 0]
    _equal_to_fold(spark, lake, wh)
    monkeypatch.setattr(wm, "MOST_DELTAS", 1)
    ingest(spark, lake, wh, _items(spark, [(500, "delete", 4, {})]))
    assert wh.current_meta(TABLE)["deltas"] == []
    _equal_to_fold(spark, lake, wh)


def _batches_read(df):
    return {int(f.split("_ingest_batch=")[1].split("/")[0]) for f in df.inputFiles() if "_ingest_batch=" in f}


def test_only_folders_of_the_range_are_opened(spark, work):
    lake = f"{work}/lake"
    for k in range(6):
        lm.append(spark, lake, _items(spark, [(10 * k + j, "insert", j, {"id": j}) for j in range(1, 6)]))
    assert _batches_read(lm.read_lake(spark, lake, lo=12, hi=23)) == {2, 3}
    assert [r[0] for r in lm.read_lake(spark, lake, lo=15, hi=22).select("sequence").orderBy("sequence").collect()] == [15, 21, 22]
    assert _batches_read(lm.read_batches(spark, lake, [4])) == {4}
    assert _batches_read(lm.read_lake(spark, lake, lo=7, hi=9)) == set()


def test_time_travel_reads_a_tail(spark, work):
    lake, wh = f"{work}/lake", Warehouse(spark, f"{work}/wh", ITEMS)
    for k in range(6):
        ingest(spark, lake, wh, _items(spark, [(10 * k + j, "update" if k else "insert", j, {"id": j, "a": 10 * k + j}) for j in range(1, 6)]))
    assert wh.version_below(TABLE, 43)["hwm"] == 35
    got = wh.asof("items", lake, 43)
    assert _batches_read(got) == {5}
    assert {r.id: r.a for r in got.collect()} == {1: 41, 2: 42, 3: 43, 4: 34, 5: 35}
    assert _batches_read(wh.asof("items", lake, 3)) == {1}              # below every version: its history
    # a late event, older than the version the tail starts from
    ingest(spark, lake, wh, _items(spark, [(26, "update", 2, {"id": 2, "b": "late"}), (27, "insert", 9, {"id": 9, "a": 9})]))
    for at in (43, 33, 60, 26, 27, 5):
        want = history.asof_sequence(lm.read_lake(spark, lake), TABLE, at, "patch")
        assert sorted(map(tuple, wh.asof("items", lake, at).select(want.columns).collect())) == sorted(map(tuple, want.collect())), at


def test_diff_builds_touched_keys_only(spark, work):
    lake, wh = _filled(spark, work, keys=50)
    ingest(spark, lake, wh, _items(spark, [(60, "update", 3, {"id": 3, "a": 30}), (61, "delete", 4, {}), (62, "insert", 77, {"id": 77}),
                                           (63, "update", 5, {"id": 5, "a": 5})]))
    assert {r.id: r.change_type for r in wh.diff("items", lake, 50, 63).collect()} == {3: "changed", 4: "removed", 77: "added"}
    assert wh.touched(TABLE, lake, 60, 62).count() == 2
    out = history.restore(spark, lake, wh, 50)
    assert out["events"] == 3
    assert {r.id: r.a for r in fm.active(wh.read("items")).collect()} == {k: k for k in range(1, 51)}
    assert wh.diff("items", lake, 50, 70).count() == 0
    _equal_to_fold(spark, lake, wh)
    ingest(spark, lake, wh, _items(spark, [(64, "update", 3, {"id": 3, "a": 64})]))
    _equal_to_fold(spark, lake, wh)


def test_compaction_keeps_what_readers_see(spark, work):
    lake, wh = f"{work}/lake", Warehouse(spark, f"{work}/wh", ITEMS)
    for k in range(5):
        lm.append(spark, lake, _items(spark, [(5 * j + k + 1, "insert" if not j else "update", j, {"id": j, "a": k}) for j in range(4)]))
    other, lease = lm.reserve_batch(spark, lake)                        # one that is still being written
    lm.append(spark, lake, _items(spark, [(100, "insert", 50, {"id": 50})]))
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    before, by_batch = rows(lm.read_lake(spark, lake)), rows(lm.read_batches(spark, lake, [2]))
    old_reader = lm.read_lake(spark, lake)
    assert lm.compact(spark, lake) == 1 and lm.compact(spark, lake) is None
    assert rows(lm.read_lake(spark, lake)) == before == rows(old_reader)
    assert rows(lm.read_batches(spark, lake, [2])) == by_batch and len(by_batch) == 4
    assert lm.started_batches(spark, lake) == [1, 2, 3, 4, 5, 6, 7] and lm.lake_max(spark, lake) == 100
    assert len(lm.segments(spark, lake)) == 2
    assert lm.vacuum(spark, lake) == 5
    assert rows(lm.read_lake(spark, lake)) == before and len(lm.read_lake(spark, lake).inputFiles()) <= 3
    again = lm.append(spark, lake, _items(spark, [(k, "insert", 1, {"id": 1}) for k in range(1, 8)]))
    assert again.written == 0 and again.already_in_lake == 7            # dedup against compacted rows
    lease.release()
    ingest(spark, lake, wh, _items(spark, [(101, "insert", 51, {"id": 51})]))
    _equal_to_fold(spark, lake, wh)
    name = lm.register_table(spark, lake, "lake_compacted_test")
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == len(before) + 1
    assert other == 6


def test_time_of_the_store(spark, work):
    fs.touch(spark, f"{work}/a/file")
    at = fs.modified(spark, f"{work}/a/file")
    assert 0 <= fs.store_time(spark, f"{work}/a") - at < 60_000 and fs.modified(spark, f"{work}/none") is None
    assert fs.list_names(spark, f"{work}/a") == ["file"]


# ------------------------------------------------------------------ scans --
@pytest.mark.parametrize("kind", ["sparse", "time", "ties"])
def test_scans_of_any_order_stay_parallel(spark, kind):
    """Sequences 2^20 apart, times, and few times with many ids each."""
    n, start = 3000, datetime(2025, 1, 1)
    if kind == "sparse":
        rows = [(0 if i % 4 else i, i << 20, i, i % 9) for i in range(n)]
        schema, order = "k long, t long, i long, v long", ["t"]
    elif kind == "time":
        rows = [(0 if i % 4 else i, start + timedelta(seconds=37 * i), i, i % 9) for i in range(n)]
        schema, order = "k long, t timestamp_ntz, i long, v long", ["t"]
    else:
        rows = [(0 if i % 4 else i, start + timedelta(days=i // 700), i, i % 9) for i in range(n)]
        schema, order = "k long, t timestamp_ntz, i long, v long", ["t", "i"]
    df = spark.createDataFrame(rows, schema)
    sizes = [r["count"] for r in scan.chunked(df, ["k"], order, 20).where("k = 0").groupBy(scan.CHUNK).count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 500
    got = {r.i: (r.n, r.s, r.p) for r in scan.over(df, ["k"], order, number="n", total={"s": F.col("v")}, prev=("q", ["i"]), chunks=20)
           .select("i", "n", "s", F.col("q.i").alias("p")).collect()}
    want, seen = {}, {}
    for k, _, i, v in rows:
        m, s, p = seen.get(k, (0, 0, None))
        want[i], seen[k] = (m + 1, s + v, p), (m + 1, s + v, i)
    assert got == want


def test_rows_without_a_key_are_scanned_too(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 1)], "k long, t long")
    assert sorted((r.k or 0, r.t, r.n) for r in scan.row_number(df, ["k"], ["t"], "n").collect()) == [(0, 1, 1), (0, 2, 2), (3, 1, 1)]


def _scans(df, capsys):
    df.explain()
    return capsys.readouterr().out.count("FileScan parquet")


def test_few_scans(spark, capsys):
    import __spark_entry__ as E
    from tidemark.contracts import TESTDATA
    sf = "/root/testdata/sf0.001"
    assert _scans(E.queries()["check_suite"](spark, sf), capsys) <= 2 * len(TESTDATA.tables)
    # per table of the feed: the stored rows for the windows and for the summary
    assert _scans(E.queries()["scd2_history"](spark, sf), capsys) <= 2 * 2
    assert _scans(E.queries()["asof_join"](spark, sf), capsys) <= 2 * 2


def test_facts_without_a_key_spread(spark):
    from tidemark.functions.joins import left_spread
    left = spark.createDataFrame([(None, i) for i in range(400)] + [(i % 3, 1000 + i) for i in range(10)], "f long, i long")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (None, "never")], "k long, name string").hint("merge")
    out = left_spread(left, right, "f", "k")
    assert out.columns == ["f", "i", "k", "name"] and out.count() == 410
    assert {(r.f, r.name) for r in out.collect()} == {(None, None), (0, "a"), (1, "b"), (2, None)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = left_spread(left, right, "f", "k").select("f", F.spark_partition_id().alias("task")).collect()
        assert len({r.task for r in rows if r.f is None}) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
