"""Writers that run at the same time: no batch is lost, none is applied before it ended."""
from concurrent.futures import ThreadPoolExecutor

import pytest

from helpers import events, rows_by_key
from tidemark.contracts import FEED
from tidemark.operators import fold, history
from tidemark.operators import lake as lm
from tidemark.operators.ingest import ingest, pending_batches
from tidemark.operators.warehouse import Warehouse
from tidemark.streaming import pipeline


def _row(seq, key, value):
    return (seq, "insert" if seq < 3 else "update", "accounts", str(key),
            {"user_id": key, "event_type": "view", "value": float(value), "k": seq})


def _state(df):
    return {k: (float(r["value"]), r["_cdc_seq"], r["_deleted"]) for k, r in rows_by_key(df, "user_id").items()}


def _agrees(spark, lake, wh):
    rows = lm.read_lake(spark, lake).where("table_name = 'accounts'")
    state = _state(wh.read("accounts"))
    assert state == _state(fold.fold(rows, FEED.table("accounts"))) and pending_batches(spark, lake, wh) == []
    return state


def _interrupt(monkeypatch, name, what):
    """Run ``what`` once inside the first call of a function of the lake."""
    real, done = getattr(lm, name), []

    def inner(*args, **kwargs):
        if not done:
            done.append(1)
            what()
        return real(*args, **kwargs)
    monkeypatch.setattr(lm, name, inner)


def _by_ingest(spark, lake, wh):
    ingest(spark, lake, wh, events(spark, [_row(2, 2, 2.0)]))


def _by_stream(spark, lake, wh):
    pipeline.make_batch_handler(lake, wh)(events(spark, [_row(2, 2, 2.0)]), 0)


def _by_restore(spark, lake, wh):
    history.restore(spark, lake, wh, 0)


@pytest.mark.parametrize("other", [_by_ingest, _by_stream, _by_restore])
@pytest.mark.parametrize("where", ["write_rows", "_commit"])
def test_a_batch_being_written_is_left_to_its_writer(spark, work, monkeypatch, other, where):
    """The other writer ends first, before this one wrote its rows or before it committed them."""
    lake, wh = f"{work}/lake", Warehouse(spark, f"{work}/wh", FEED)
    ingest(spark, lake, wh, events(spark, [_row(1, 9, 9.0)]))
    _interrupt(monkeypatch, where, lambda: other(spark, lake, Warehouse(spark, f"{work}/wh", FEED)))
    ingest(spark, lake, wh, events(spark, [_row(3, 1, 1.0), _row(4, 9, 4.0)]))
    state = _agrees(spark, lake, wh)
    assert state[1][:2] == (1.0, 3)
    ingest(spark, lake, wh, events(spark, [_row(5, 1, 5.0)]))
    assert _agrees(spark, lake, wh)[1][:2] == (5.0, 5)


@pytest.mark.parametrize("where", ["write_rows", "_commit"])
def test_a_slow_writer_taken_for_dead_loses_nothing(spark, work, monkeypatch, where):
    lake, wh = f"{work}/lake", Warehouse(spark, f"{work}/wh", FEED)
    monkeypatch.setattr(lm, "alive", lambda *a: False)

    def other():
        _by_ingest(spark, lake, wh)
        assert 1 in wh.applied_batches()        # taken over, whatever of it was there
    _interrupt(monkeypatch, where, other)
    report = ingest(spark, lake, wh, events(spark, [_row(1, 1, 1.0)]))
    assert report.append.batch_id == 3 and report.append.written == 1
    assert _agrees(spark, lake, wh) == {1: (1.0, 1, False), 2: (2.0, 2, False)}
    assert lm.read_batches(spark, lake, [3]).count() == 1 and lm.lake_max(spark, lake) == 2


def test_a_dead_writer_is_taken_over_when_its_lease_ends(spark, work, monkeypatch):
    lake, wh = f"{work}/lake", Warehouse(spark, f"{work}/wh", FEED)
    batch, lease = lm.reserve_batch(spark, lake)
    lease.ended.set()                            # the process is gone, its file is not
    _by_ingest(spark, lake, wh)
    assert batch == 1 and wh.applied_batches() == [2] and lm.settled_batches(spark, lake) == [2]
    monkeypatch.setattr(lm, "LEASE_SECONDS", -1)
    ingest(spark, lake, wh, events(spark, [_row(3, 1, 3.0)]))
    assert wh.applied_batches() == [1, 2, 3] and set(_agrees(spark, lake, wh)) == {1, 2}


def test_ids_are_taken_once(spark, work):
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: lm.reserve_batch(spark, f"{work}/lake"), range(16)))
    assert sorted(b for b, _ in got) == list(range(1, 17))
    for _, lease in got:
        lease.release()
    assert lm.settled_batches(spark, f"{work}/lake") == list(range(1, 17))


def test_writers_in_parallel(spark, work):
    """Appends and applies of four threads, each with its own warehouse object."""
    lake = f"{work}/lake"

    def one(k):
        wh = Warehouse(spark, f"{work}/wh", FEED)
        for j in range(2):
            ingest(spark, lake, wh, events(spark, [_row(10 * k + j + 3, n, k + j) for n in (k, 100)][:1] + [
                (10 * k + j + 5, "update", "accounts", "100", {"user_id": 100, "event_type": "view", "k": k, "value": 1.0 * k})]))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(one, range(4)))
    wh = Warehouse(spark, f"{work}/wh", FEED)
    ingest(spark, lake, wh, events(spark, [_row(1000, 7, 7.0)]))
    state = _agrees(spark, lake, wh)
    assert state[100][1] == 36 and lm.read_lake(spark, lake).select("sequence").distinct().count() == 17
