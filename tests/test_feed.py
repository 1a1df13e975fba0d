"""Change feed: operation domain, offsets, latest sequence."""
import pytest

from helpers import events
from tidemark.operators import lake as lm


def test_bad_operation_rejected_at_lake_door(spark, work):
    ev = events(spark, [(1, "invalid_op", "customers", "c1", {"customer_id": "c1"})])
    with pytest.raises(lm.InvalidOperationError, match="Invalid CDC operation"):
        lm.append(spark, f"{work}/lake", ev)
    assert lm.read_lake(spark, f"{work}/lake").count() == 0


def test_sequences_and_latest(spark):
    ev = events(spark, [(1, "insert", "customers", "c1", {"customer_id": "c1", "name": "Ada"}),
                        (2, "update", "customers", "c1", {"customer_id": "c1", "name": "Ada L"}),
                        (3, "delete", "customers", "c1", {"customer_id": "c1"})])
    assert [r.sequence for r in ev.orderBy("sequence").collect()] == [1, 2, 3]
    assert lm.latest_sequence(ev).first()[0] == 3
    assert lm.latest_sequence(ev.limit(0)).first()[0] == 0


def test_replay_since_offset(spark):
    ev = events(spark, [(1, "insert", "wallets", "w1", {"wallet_id": "w1"}),
                        (2, "update", "wallets", "w1", {"wallet_id": "w1"}),
                        (3, "update", "wallets", "w1", {"wallet_id": "w1"})])
    assert sorted(r.sequence for r in lm.since(ev, 1).collect()) == [2, 3]
    assert lm.since(ev, 3).count() == 0
    assert lm.since(ev).count() == 3


def test_operation_report(spark):
    ev = events(spark, [(1, "insert", "t", "1", {}), (2, "upsert", "t", "1", {})])
    rep = {r.operation: (r.events, r.is_valid) for r in lm.operation_check(ev).collect()}
    assert rep == {"insert": (1, True), "upsert": (1, False)}
