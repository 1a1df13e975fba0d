"""Catalog: shipped document, validation messages, drift, discovery, profile, registration."""
import json

from helpers import events
from tidemark.contracts import FEED, PAYMENTS
from tidemark.operators import catalog as C
from tidemark.operators import fold as fm


def test_shipped_catalog_is_valid_and_matches_contract(spark):
    path = C.shipped_catalog_path()
    assert C.validation_errors(spark, path) == []
    assert json.load(open(path)) == C.build_document(PAYMENTS)
    ent = C.entries(spark, path)
    assert sorted(r.name for r in ent.collect()) == sorted(["lake_cdc_events"] + [t.wh_name for t in PAYMENTS.tables])


def test_missing_catalog_file(spark, work):
    errs = C.validation_errors(spark, f"{work}/nope.json")
    assert len(errs) == 1 and "not found" in errs[0]


def test_broken_catalog_messages(spark, work):
    doc = {"catalog_name": "x", "datasets": [
        {"name": "a", "layer": "bronze", "table_name": "", "owner": None, "intended_audience": "i",
         "update_cadence": "u", "description": "d", "schema": [{"name": "c1", "type": "INTEGER"}]},
        {"layer": "lake", "table_name": "t", "owner": "o", "intended_audience": "i", "update_cadence": "u",
         "description": "d", "schema": []},
        {"name": "w", "layer": "lake", "table_name": "t", "owner": "o", "intended_audience": "i",
         "update_cadence": "u", "description": "d", "schema": "cols"}]}
    path = f"{work}/cat.json"
    C.write_document(spark, path, doc)
    assert C.validation_errors(spark, path) == [
        "Catalog missing root field: 'version'",
        "Dataset 'a' missing required field: 'table_name'",
        "Dataset 'a' missing required field: 'owner'",
        "Dataset 'a' has invalid layer 'bronze'. Must be one of: ['lake', 'warehouse']",
        "Dataset 'a' column 'c1' missing required attribute: 'description'",
        "Dataset 'a' column 'c1' missing required attribute: 'nullable'",
        "Dataset 'dataset[1]' missing required field: 'name'",
        "Dataset 'dataset[1]' schema column list is empty.",
        "Dataset 'w' field 'schema' must be a list of columns.",
        "Catalog contains no 'warehouse' datasets.",
    ]


def test_unparsable_and_non_list(spark, work):
    p1 = f"{work}/bad.json"
    from tidemark.sources import fs
    fs.write_text_atomic(spark, p1, "{not json")
    assert C.validation_errors(spark, p1)[0].startswith("Failed to parse JSON catalog file")
    p2 = f"{work}/nolist.json"
    fs.write_text_atomic(spark, p2, json.dumps({"version": "1", "datasets": {"a": 1}}))
    assert C.validation_errors(spark, p2) == ["Catalog missing root list field: 'datasets'"]


def test_discover(spark):
    ent = C.entries(spark, C.shipped_catalog_path())
    assert C.discover(ent, layer="lake").count() == 1
    assert sorted(r.name for r in C.discover(ent, column="wallet_id").collect()) == [
        "wh_ledger_entries", "wh_transactions", "wh_wallets"]


def test_drift_and_profile(spark, work):
    ev = events(spark, [(1, "insert", "accounts", "1", {"user_id": 1, "event_type": "signup", "value": 2.5, "k": 1}),
                        (2, "update", "accounts", "1", {"user_id": 1, "event_type": None})])
    wh = fm.fold(ev, FEED.table("accounts"))
    pub = spark.createDataFrame(
        [("wh_accounts", "user_id", "BIGINT", False), ("wh_accounts", "event_type", "VARCHAR", False),
         ("wh_accounts", "value", "DECIMAL(18, 2)", True), ("wh_accounts", "k", "INTEGER", True),
         ("wh_accounts", "gone", "VARCHAR", True)],
        "dataset string, column_name string, published_type string, published_nullable boolean")
    d = {r.column_name: (r.drift, r.null_rows) for r in C.drift(pub, {"wh_accounts": wh}).collect()}
    assert d == {"user_id": ("ok", 0), "event_type": ("nulls", 1), "value": ("ok", None),
                 "k": ("type", None), "gone": ("missing", None)}
    prof = {r.dataset: r for r in C.profile({"lake": ("lake", ev), "wh_accounts": ("warehouse", wh)}).collect()}
    assert prof["lake"].rows == 2 and prof["lake"].max_sequence == 2
    assert prof["wh_accounts"].active_rows == 1 and prof["wh_accounts"].max_sequence == 2


def test_register_in_spark_catalog(spark, work):
    from tidemark.operators.ingest import ingest
    from tidemark.operators.warehouse import Warehouse
    wh = Warehouse(spark, f"{work}/wh", FEED)
    ingest(spark, f"{work}/lake", wh, events(spark, [
        (1, "insert", "accounts", "1", {"user_id": 1, "event_type": "signup", "value": 2.5, "k": 1})]))
    doc = C.build_document(FEED)
    t = FEED.table("accounts")
    loc = wh.location(t)
    made = C.register(spark, doc, {"lake_cdc_events": f"{work}/lake", "wh_accounts": loc}, database="tm_test")
    assert len(made) == 2
    assert spark.table("tm_test.wh_accounts").count() == 1
    assert spark.table("tm_test.lake_cdc_events").count() == 1
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES tm_test.wh_accounts").collect()}
    assert props["layer"] == "warehouse" and props["data_owner"] == "data platform"
    assert {t.name for t in spark.catalog.listTables("tm_test")} == {"wh_accounts", "lake_cdc_events"}
    by_layer = C.register(spark, doc, {"lake_cdc_events": f"{work}/lake", "wh_accounts": loc})
    assert sorted(by_layer) == ["`lake`.`lake_cdc_events`", "`warehouse`.`wh_accounts`"]
