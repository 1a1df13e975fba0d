"""Warehouse apply, time travel, restore.

The property test compares the warehouse after random micro-batches
(random split, order, duplicates) against a plain Python fold written from
the apply rules: row exists iff some upsert; each column from the newest
upsert that carries the key; _cdc_seq = newest sequence; _deleted = newest
event is a delete."""
from datetime import datetime
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import events, rows_by_key
from tidemark.contracts import LONG, PAYMENTS, STR, Contract, TableContract, _c
from tidemark.operators import fold as fm
from tidemark.operators import history
from tidemark.operators import lake as lm
from tidemark.operators.ingest import ingest
from tidemark.operators.warehouse import Warehouse

ITEMS = Contract(name="items", tables=(
    TableContract("items", (_c("id", LONG, False), _c("a", LONG), _c("b", STR)), pk=("id",)),))


def _wh(spark, work, contract=ITEMS):
    return f"{work}/lake", Warehouse(spark, f"{work}/wh", contract)


def _state(wh, table="items", key="id"):
    return rows_by_key(wh.read(table), key)


def test_upsert_and_soft_delete(spark, work):
    lake, wh = _wh(spark, work, PAYMENTS)
    log = [(1, "insert", "customers", "c1", {"customer_id": "c1", "name": "Ines", "email": "i@x.org",
                                             "status": "active", "created_at": "2025-01-01T00:00:00",
                                             "updated_at": "2025-01-01T00:00:00"}),
           (2, "update", "customers", "c1", {"customer_id": "c1", "name": "Ines", "email": "i@x.org",
                                             "status": "suspended", "created_at": "2025-01-01T00:00:00",
                                             "updated_at": "2025-01-02T00:00:00"}),
           (3, "delete", "customers", "c1", {"customer_id": "c1"})]
    expected = [(1, False, "active"), (2, False, "suspended"), (3, True, "suspended")]
    for i in range(3):
        ingest(spark, lake, wh, events(spark, log[: i + 1]))  # whole log re-applied each time
        row = _state(wh, "customers", "customer_id")["c1"]
        assert (row["_cdc_seq"], row["_deleted"], row["status"]) == expected[i]


def test_time_travel_through_delete_and_revival(spark, work):
    lake, wh = _wh(spark, work, PAYMENTS)
    log = [(11, "insert", "wallets", "w-7", {"wallet_id": "w-7", "currency": "EUR", "status": "active"}),
           (12, "update", "wallets", "w-7", {"wallet_id": "w-7", "status": "frozen"}),
           (14, "insert", "wallets", "w-3", {"wallet_id": "w-3", "currency": "NOK", "status": "active"}),
           (15, "delete", "wallets", "w-7", {}),
           (18, "update", "wallets", "w-3", {"wallet_id": "w-3", "currency": "SEK"}),
           (19, "insert", "wallets", "w-7", {"wallet_id": "w-7", "currency": "USD", "status": "closed"}),
           (20, "delete", "wallets", "w-3", {})]
    for part in (log[4:], log[:2], log[2:4]):            # out of order
        lm.append(spark, lake, events(spark, part))
    ev = lm.read_lake(spark, lake).where("table_name = 'wallets'")
    states = {10: {}, 11: {"w-7": ("EUR", "active")}, 13: {"w-7": ("EUR", "frozen")},
              14: {"w-7": ("EUR", "frozen"), "w-3": ("NOK", "active")}, 16: {"w-3": ("NOK", "active")},
              18: {"w-3": ("SEK", "active")}, 19: {"w-3": ("SEK", "active"), "w-7": ("USD", "closed")},
              99: {"w-7": ("USD", "closed")}}
    for at, want in states.items():
        rows = history.asof_sequence(ev, PAYMENTS.table("wallets"), at, mode="patch").collect()
        assert {r.wallet_id: (r.currency, r.status) for r in rows} == want, at


def test_asof_capture_time_folds_by_sequence(spark):
    from datetime import datetime as dt
    ev = events(spark, [(1, "insert", "items", "1", {"id": 1, "a": 1}, dt(2025, 1, 1, 10)),
                        (3, "update", "items", "1", {"id": 1, "a": 3}, dt(2025, 1, 1, 11)),
                        (2, "update", "items", "1", {"id": 1, "a": 2}, dt(2025, 1, 1, 12))])
    t = ITEMS.table("items")
    at = {r.id: r.a for r in history.asof_time(ev, t, F.lit(dt(2025, 1, 1, 11)).cast("timestamp_ntz")).collect()}
    assert at == {1: 3}  # known at 11:00: events 1 and 3; folded by sequence
    at = {r.id: r.a for r in history.asof_time(ev, t, F.lit(dt(2025, 1, 1, 12)).cast("timestamp_ntz")).collect()}
    assert at == {1: 3}  # the late event 2 arrives at 12:00 but is older than 3


def _items(spark, rows):
    return events(spark, [(s, op, "items", str(k), d) for s, op, k, d in rows])


def test_stale_batch_replay(spark, work):
    lake, wh = _wh(spark, work)
    ingest(spark, lake, wh, _items(spark, [(1, "insert", 1, {"id": 1, "a": 1}), (2, "update", 1, {"id": 1, "a": 2})]))
    ingest(spark, lake, wh, _items(spark, [(1, "insert", 1, {"id": 1, "a": 1})]))
    row = _state(wh)[1]
    assert (row["a"], row["_cdc_seq"]) == (2, 2)


def test_late_event_patch_merged(spark, work):
    lake, wh = _wh(spark, work)
    ingest(spark, lake, wh, _items(spark, [(1, "insert", 1, {"id": 1, "a": 1, "b": "x"}),
                                           (3, "update", 1, {"id": 1, "a": 3})]))
    rep = ingest(spark, lake, wh, _items(spark, [(2, "update", 1, {"id": 1, "b": "y"})]))
    assert rep.applied[0].path == "general" and rep.applied[0].late == 1
    row = _state(wh)[1]
    assert (row["a"], row["b"], row["_cdc_seq"], row["_deleted"]) == (3, "y", 3, False)


def test_mixed_batch_routes_late_keys_only(spark, work):
    lake, wh = _wh(spark, work)
    ingest(spark, lake, wh, _items(spark, [(1, "insert", 1, {"id": 1, "a": 1, "b": "x"}),
                                           (3, "insert", 2, {"id": 2, "a": 2}),
                                           (5, "update", 1, {"id": 1, "a": 5})]))
    rep = ingest(spark, lake, wh, _items(spark, [(4, "update", 1, {"id": 1, "b": "late"}),
                                                 (6, "update", 2, {"id": 2, "b": "new"}),
                                                 (7, "insert", 3, {"id": 3, "a": 3})]))
    assert (rep.applied[0].path, rep.applied[0].late) == ("mixed", 1)
    s = _state(wh)
    assert {k: (v["a"], v["b"], v["_cdc_seq"]) for k, v in s.items()} == {
        1: (5, "late", 5), 2: (2, "new", 6), 3: (3, None, 7)}


def test_delete_before_insert(spark, work):
    lake, wh = _wh(spark, work)
    ingest(spark, lake, wh, _items(spark, [(2, "delete", 1, {})]))
    assert wh.read("items").count() == 0
    ingest(spark, lake, wh, _items(spark, [(1, "insert", 1, {"id": 1, "a": 1})]))
    row = _state(wh)[1]
    assert (row["_deleted"], row["_cdc_seq"], row["a"]) == (True, 2, 1)


def test_orphan_delete_leaves_no_row(spark, work):
    lake, wh = _wh(spark, work)
    ingest(spark, lake, wh, _items(spark, [(5, "delete", 9, {})]))
    assert wh.read("items").count() == 0


def test_revive_with_partial_payload(spark, work):
    lake, wh = _wh(spark, work)
    ingest(spark, lake, wh, _items(spark, [(1, "insert", 1, {"id": 1, "a": 1, "b": "x"}),
                                           (2, "update", 1, {"id": 1, "a": None}),
                                           (3, "delete", 1, {}),
                                           (4, "insert", 1, {"id": 1, "b": "z"})]))
    row = _state(wh)[1]
    assert (row["a"], row["b"], row["_deleted"], row["_cdc_seq"]) == (None, "z", False, 4)


def test_absent_key_keeps_value_explicit_null_clears(spark, work):
    lake, wh = _wh(spark, work)
    ingest(spark, lake, wh, _items(spark, [(1, "insert", 1, {"id": 1, "a": 5}), (2, "insert", 2, {"id": 2, "a": 6})]))
    ingest(spark, lake, wh, _items(spark, [(3, "update", 1, {}), (4, "update", 2, {"a": None})]))
    s = _state(wh)
    assert s[1]["a"] == 5 and s[2]["a"] is None


def test_big_money_exact_and_zoned_text(spark, work):
    lake, wh = _wh(spark, work, PAYMENTS)
    payload = ('{"wallet_id": "w1", "customer_id": "c1", "balance": 9999999999999999.99, "currency": "EUR", '
               '"status": "active", "created_at": "2024-01-01T12:00:00+05:30", "updated_at": "2024-01-01T12:00:00"}')
    ingest(spark, lake, wh, events(spark, [(1, "insert", "wallets", "w1", payload)]))
    row = _state(wh, "wallets", "wallet_id")["w1"]
    assert row["balance"] == Decimal("9999999999999999.99")
    assert row["created_at"] == datetime(2024, 1, 1, 6, 30)
    assert row["updated_at"] == datetime(2024, 1, 1, 12, 0)


def test_unknown_table_in_lake_not_in_warehouse(spark, work):
    lake, wh = _wh(spark, work)
    ingest(spark, lake, wh, events(spark, [(1, "insert", "audit", "a1", {"x": 1}),
                                           (2, "insert", "items", "1", {"id": 1, "a": 1})]))
    assert lm.read_lake(spark, lake).count() == 2
    assert wh.read("items").count() == 1


def test_crash_between_lake_and_warehouse(spark, work):
    lake, wh = _wh(spark, work)
    ev = _items(spark, [(1, "insert", 1, {"id": 1, "a": 1}), (2, "update", 1, {"id": 1, "a": 2})])
    lm.append(spark, lake, ev)  # the run died here: lake written, warehouse not
    assert wh.read("items").count() == 0
    rep = ingest(spark, lake, wh, ev)  # rerun of the same input
    assert rep.append.written == 0
    assert lm.read_lake(spark, lake).count() == 2
    assert _state(wh)[1]["a"] == 2


def test_restore_then_new_and_late_events(spark, work):
    lake, wh = _wh(spark, work)
    ingest(spark, lake, wh, _items(spark, [(1, "insert", 1, {"id": 1, "a": 1, "b": "p"}),
                                           (2, "insert", 2, {"id": 2, "a": 2}),
                                           (4, "update", 1, {"id": 1, "a": 10}),
                                           (5, "delete", 2, {}),
                                           (6, "insert", 3, {"id": 3, "a": 3})]))
    out = history.restore(spark, lake, wh, target_sequence=2)
    assert out["sequence"] == 6 and out["restore_no"] == 1
    s = _state(wh)
    assert {k: (v["a"], v["b"], v["_deleted"]) for k, v in s.items()} == {
        1: (1, "p", False), 2: (2, None, False), 3: (3, None, True)}
    ingest(spark, lake, wh, _items(spark, [(7, "update", 1, {"id": 1, "b": "q"})]))  # new source event
    ingest(spark, lake, wh, _items(spark, [(3, "update", 2, {"id": 2, "a": 99})]))  # late, below the restore
    s = _state(wh)
    assert (s[1]["a"], s[1]["b"]) == (1, "q")
    assert s[2]["a"] == 2
    lake_rows = lm.read_lake(spark, lake)
    assert lake_rows.where("_restore_no = 1").count() == 3
    assert lake_rows.where("_restore_no = 0").count() == 7  # history untouched
    # As of 6 means before the restore cut at 6.
    before = {r.id: r.a for r in history.asof_sequence(lake_rows.where("table_name='items'"),
                                                       ITEMS.table("items"), 6, "patch").collect()}
    assert before == {1: 10, 3: 3}


def test_versioned_reads(spark, work):
    lake, wh = _wh(spark, work)
    ingest(spark, lake, wh, _items(spark, [(1, "insert", 1, {"id": 1, "a": 1})]))
    ingest(spark, lake, wh, _items(spark, [(2, "update", 1, {"id": 1, "a": 2})]))
    assert wh.read("items", version=1).first().a == 1
    assert wh.read("items", version=2).first().a == 2
    assert [m["version"] for m in wh.commits(ITEMS.table("items"))] == [1, 2]


# ----------------------------------------------------------------- property --
def py_fold(evs):
    out = {}
    by_key = {}
    for seq, op, k, data in evs:
        by_key.setdefault(k, []).append((seq, op, data))
    for k, es in by_key.items():
        es.sort()
        ups = [e for e in es if e[1] != "delete"]
        if not ups:
            continue
        row = {"id": k, "a": None, "b": None}
        for c in ("a", "b"):
            for seq, op, data in ups:
                if c in data:
                    row[c] = data[c]
        row["_cdc_seq"] = es[-1][0]
        row["_deleted"] = es[-1][1] == "delete"
        out[k] = row
    return out


payloads = st.fixed_dictionaries({}, optional={"a": st.one_of(st.none(), st.integers(-5, 5)),
                                               "b": st.one_of(st.none(), st.sampled_from(["x", "y"]))})
event_lists = st.lists(st.tuples(st.integers(1, 3), st.sampled_from(["insert", "update", "delete"]), payloads,
                                 st.integers(0, 2)), min_size=1, max_size=9)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(event_lists, st.randoms(use_true_random=False))
def test_batches_equal_python_fold_and_rebuild(spark, evs, rnd):
    from tidemark.session import new_work_dir
    work = new_work_dir(spark, "prop")
    rows = []
    for seq, (k, op, data, batch) in enumerate(evs, start=1):
        data = {} if op == "delete" else {"id": k, **data}
        rows.append((seq, op, k, data, batch))
    expected = py_fold([(s, op, k, d) for s, op, k, d, _ in rows])
    lake, wh = _wh(spark, work)
    order = [0, 1, 2]
    rnd.shuffle(order)
    for b in order + [order[0]]:  # one batch is delivered twice
        part = [(s, op, k, d) for s, op, k, d, bb in rows if bb == b]
        if part:
            ingest(spark, lake, wh, _items(spark, part))
    assert _state(wh) == expected
    rebuilt = fm.fold(lm.read_lake(spark, lake), ITEMS.table("items"))
    assert rows_by_key(rebuilt, "id") == expected


def test_asof_raw_includes_unknown_tables(spark):
    ev = events(spark, [(1, "insert", "audit", "a1", {"who": "x"}),
                        (2, "insert", "items", "1", {"id": 1, "a": 1}),
                        (3, "delete", "items", "1", {}),
                        (4, "update", "audit", "a1", {"who": "y"})])
    at3 = {(r.table_name, r.primary_key): r.data for r in history.asof_raw(ev, 3).collect()}
    assert at3 == {("audit", "a1"): '{"who": "x"}'}
    at2 = {(r.table_name, r.primary_key) for r in history.asof_raw(ev, 2).collect()}
    assert at2 == {("audit", "a1"), ("items", "1")}
