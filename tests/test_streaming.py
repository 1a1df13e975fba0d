"""Structured Streaming ingestion: restart, replayed epochs, stop-the-line."""
import pytest

from helpers import events, rows_by_key
from tidemark.contracts import FEED
from tidemark.operators import lake as lm
from tidemark.operators import schema_gate as G
from tidemark.operators.warehouse import Warehouse
from tidemark.streaming import pipeline


def _ev(spark, rows):
    return events(spark, [(s, op, "accounts", str(k), d) for s, op, k, d in rows])


def _drop(spark, landing, rows):
    _ev(spark, rows).coalesce(1).write.mode("append").parquet(landing)


def test_restart_picks_up_new_files(spark, work):
    landing, lake, ckpt = f"{work}/landing", f"{work}/lake", f"{work}/ckpt"
    wh = Warehouse(spark, f"{work}/wh", FEED)
    _drop(spark, landing, [(1, "insert", 1, {"user_id": 1, "event_type": "signup", "value": 1.0, "k": 1}),
                           (2, "insert", 2, {"user_id": 2, "event_type": "signup", "value": 2.0, "k": 2})])
    pipeline.run_available(pipeline.read_feed_files(spark, landing), lake, wh, ckpt)
    # late event (seq 3 arrives after 4), a duplicate of 1, and a delete
    _drop(spark, landing, [(4, "update", 1, {"user_id": 1, "event_type": "view", "k": 40})])
    _drop(spark, landing, [(3, "update", 1, {"user_id": 1, "event_type": "click", "value": 3.0}),
                           (1, "insert", 1, {"user_id": 1, "event_type": "signup", "value": 1.0, "k": 1}),
                           (5, "delete", 2, {})])
    metrics = []
    pipeline.run_available(pipeline.read_feed_files(spark, landing, max_files_per_trigger=1), lake, wh, ckpt,
                           metrics=metrics)
    assert len(metrics) == 2  # the first file was not read again
    assert lm.read_lake(spark, lake).count() == 5
    s = rows_by_key(wh.read("accounts"), "user_id")
    assert (s[1]["event_type"], float(s[1]["value"]), s[1]["k"], s[1]["_cdc_seq"]) == ("view", 3.0, 40, 4)
    assert s[2]["_deleted"] is True


def test_replayed_epoch_is_idempotent(spark, work):
    lake = f"{work}/lake"
    wh = Warehouse(spark, f"{work}/wh", FEED)
    handle = pipeline.make_batch_handler(lake, wh)
    batch = _ev(spark, [(1, "insert", 1, {"user_id": 1, "event_type": "signup", "value": 1.5, "k": 7})])
    handle(batch, 0)
    handle(batch, 0)  # the same epoch delivered again after a restart
    assert lm.read_lake(spark, lake).count() == 1
    assert wh.applied_batches() == lm.started_batches(spark, lake)
    assert wh.read("accounts").count() == 1


def test_stop_the_line_fails_before_any_write(spark, work):
    landing, lake, ckpt = f"{work}/landing", f"{work}/lake", f"{work}/ckpt"
    wh = Warehouse(spark, f"{work}/wh", FEED)
    _drop(spark, landing, [(1, "insert", 1, {"user_id": 1, "event_type": "signup", "renamed_value": 1.0})])
    for _ in range(2):  # the offset is not committed: a restart meets the same batch
        with pytest.raises(Exception, match="STOP-THE-LINE"):
            pipeline.run_available(pipeline.read_feed_files(spark, landing), lake, wh, ckpt)
    assert lm.read_lake(spark, lake).count() == 0
    assert wh.read("accounts").count() == 0
    assert issubclass(G.SchemaIncompatibilityError, Exception)


def test_watermark_prefilter_then_exact_dedup(spark, work):
    landing, lake, ckpt = f"{work}/landing", f"{work}/lake", f"{work}/ckpt"
    row = (1, "insert", 1, {"user_id": 1, "event_type": "signup", "value": 1.0, "k": 1})
    _drop(spark, landing, [row, row])
    _drop(spark, landing, [row, (2, "update", 1, {"user_id": 1, "event_type": "view", "k": 2})])
    metrics = []
    pipeline.run_available(pipeline.read_feed_files(spark, landing, max_files_per_trigger=1), lake, None, ckpt,
                           metrics=metrics, dedup_watermark="1 hour")
    assert lm.read_lake(spark, lake).count() == 2
    assert sum(m["append"].written for m in metrics if m["append"] is not None) == 2
