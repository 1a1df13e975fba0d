"""Schema contract checks and the stop-the-line payload gate."""
import pytest
from pyspark.sql import types as T

from helpers import events, source_tables
from tidemark.contracts import FEED, PAYMENTS, retyped
from tidemark.operators import lake as lm
from tidemark.operators import schema_gate as G
from tidemark.operators.ingest import ingest
from tidemark.operators.warehouse import Warehouse


def test_clean_contract_passes(spark):
    tables = source_tables(spark)
    assert G.check_schema(tables, PAYMENTS) == []
    G.assert_schema_compatible(tables, PAYMENTS)


def test_dropped_column_stops_the_line(spark):
    tables = source_tables(spark)
    tables["ledger_entries"] = tables["ledger_entries"].drop("balance_after")
    problems = G.check_schema(tables, PAYMENTS)
    assert problems == ["ledger_entries.balance_after: required column missing from source table (dropped or renamed)"]
    with pytest.raises(G.SchemaIncompatibilityError, match="STOP-THE-LINE"):
        G.assert_schema_compatible(tables, PAYMENTS)


def test_missing_table_reported_and_others_checked(spark):
    tables = source_tables(spark)
    del tables["merchants"]
    tables["wallets"] = tables["wallets"].drop("currency")
    problems = G.check_schema(tables, PAYMENTS)
    assert problems == [
        "wallets.currency: required column missing from source table (dropped or renamed)",
        "merchants: table missing or describe failed — no such table"]


def test_schema_report_types_and_domains(spark):
    tables = source_tables(spark, customers=[("c1", "Ann", "a@x", "gone", None, None)])
    tables["wallets"] = tables["wallets"].withColumn("balance", tables["wallets"]["balance"].cast("double"))
    rep = {(r.table_name, r.column_name, r.problem): r for r in G.schema_report(tables, PAYMENTS).collect()}
    assert rep[("wallets", "balance", "type_changed")].actual == "double"
    assert rep[("customers", "status", "outside_domain")].rows == 1
    assert rep[("transactions", "status", "outside_domain")].rows == 0


def _feed(spark, rows):
    return events(spark, [(s, op, "accounts", str(k), d) for s, op, k, d in rows])


def test_payload_drift_reports(spark):
    ev = _feed(spark, [(1, "insert", 1, {"user_id": 1, "event_type": "signup", "value": 1.5, "k": 1, "extra": 2}),
                       (2, "update", 1, {"user_id": 1, "event_type": "view"}),
                       (3, "update", 2, {"user_id": 3, "event_type": "click", "value": "abc", "k": 1})])
    drift = {(r.key_name, r.drift): (r.events, r.first_sequence) for r in G.payload_key_drift(ev, FEED).collect()}
    assert drift[("extra", "unknown_key")] == (1, 1)
    assert drift[("value", "missing_key")] == (1, 2)
    bad = {r.column_name: r.bad_values for r in G.payload_type_drift(ev, FEED).collect()
           if r.table_name == "accounts"}
    assert bad == {"user_id": 0, "event_type": 0, "value": 1, "k": 0}
    agree = G.key_agreement(ev, FEED).first()
    assert (agree.upserts, agree.mismatches) == (3, 1)


@pytest.mark.parametrize("payload", [
    {"user_id": 1, "event_type": "view", "surprise": 1},   # unknown key
    {"user_id": 1, "event_type": "view", "value": "12,5"},  # wrong type
    {"user_id": 2, "event_type": "view"},                   # key mismatch
])
def test_gate_stops_before_any_write(spark, work, payload):
    wh = Warehouse(spark, f"{work}/wh", FEED)
    with pytest.raises(G.SchemaIncompatibilityError, match="STOP-THE-LINE"):
        ingest(spark, f"{work}/lake", wh, _feed(spark, [(1, "update", 1, payload)]))
    assert lm.read_lake(spark, f"{work}/lake").count() == 0
    assert wh.read("accounts").count() == 0


def test_narrowed_contract_flags_values(spark):
    ev = _feed(spark, [(1, "insert", 1, {"user_id": 1, "event_type": "signup", "value": 123.45, "k": 1})])
    narrow = retyped(FEED, "value", T.DecimalType(4, 2))
    bad = {r.column_name: r.bad_values for r in G.payload_type_drift(ev, narrow).collect() if r.table_name == "accounts"}
    assert bad["value"] == 1
