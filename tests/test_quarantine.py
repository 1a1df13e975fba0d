"""Release of held events: the repair runs once, whatever reads its result."""
from __future__ import annotations

from helpers import events
from pyspark.sql import functions as F

from tidemark.contracts import FEED
from tidemark.operators import quarantine as q


def _row(key, value):
    return {"user_id": key, "event_type": "view", "value": value, "k": 1}


def test_release_repairs_each_held_event_once(spark, work):
    held = events(spark, [(s, "update", "accounts", s, "broken") for s in range(2, 22, 2)]
                  + [(s, "update", "devices", s, "broken") for s in (1, 3)])
    _, bad = q.split(held, FEED)
    q.store(bad, work, "first")
    runs = spark.sparkContext.accumulator(0)

    def mend(key):
        runs.add(1)
        return "broken" if key == "3" else '{"user_id": %s, "event_type": "view", "value": 1.5, "k": 1}' % key

    taken = []

    def accept(rows):
        assert rows.count() == 11 and rows.agg(F.max("sequence")).first()[0] == 20
        taken.extend(rows.orderBy("sequence").collect())

    counts = q.release(spark, work, lambda rows: rows.withColumn("data", F.udf(mend)("primary_key")), FEED, accept, "again")
    assert counts == {"released": 11, "held": 1}
    assert [r["sequence"] for r in taken] == [1, *range(2, 22, 2)]
    assert all(r["data"].startswith("{") for r in taken)
    left = q.read(spark, work).collect()
    assert [(r["sequence"], r["primary_key"], r["reasons"]) for r in left] == [(3, "3", ["malformed"])]
    assert runs.value == 12


def test_release_hands_nothing_on_when_nothing_is_mended(spark, work):
    _, bad = q.split(events(spark, [(1, "upsert", "accounts", 1, _row(1, 2.5))]), FEED)
    q.store(bad, work, "first")
    counts = q.release(spark, work, lambda rows: rows, FEED, lambda rows: 1 / 0, "again")
    assert counts == {"released": 0, "held": 1}
    assert q.read(spark, work).count() == 1
