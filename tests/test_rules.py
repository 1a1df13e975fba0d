"""Data-quality suite: the reference's 49 rules and contract-generated rules."""
from datetime import datetime
from decimal import Decimal

from helpers import events, source_tables
from tidemark.contracts import PAYMENTS
from tidemark.operators import fold as fm
from tidemark.operators import rules as R
from tidemark.operators.ingest import ingest
from tidemark.operators.warehouse import Warehouse

D = datetime(2025, 2, 1, 8, 0)
D2 = datetime(2025, 2, 1, 9, 0)
CUST = [("cu1", "Rhea Quist", "rhea@example.net", "active", D, D),
        ("cu2", "Tomas Ek", "tomas@example.net", "suspended", D, D)]
WAL = [("wa1", "cu1", Decimal("120.00"), "SEK", "active", D, D),
       ("wa2", "cu2", Decimal("0.00"), "SEK", "frozen", D, D)]
MER = [("me1", "Bakery Nord", "shop@example.net", "active", D)]
TXN = [("tx1", "wa1", "me1", Decimal("30.00"), Decimal("0.50"), "debit", "settled", "inv-7", D, D2)]
LED = [("le1", "tx1", "wa1", "debit", Decimal("30.00"), Decimal("90.00"), D)]


def _payload(t, row):
    d = {}
    for c, v in zip(PAYMENTS.table(t).column_names, row):
        d[c] = v.isoformat() if isinstance(v, datetime) else (str(v) if isinstance(v, Decimal) else v)
    import json
    return json.dumps(d).replace('"120.00"', "120.00").replace('"0.00"', "0.00")


def _demo(spark, work, extra=()):
    """Source tables plus a warehouse fed by five captured events."""
    src = source_tables(spark, customers=CUST, wallets=WAL, merchants=MER, transactions=TXN, ledger_entries=LED)
    log = [(1, "insert", "customers", "cu1", _payload("customers", CUST[0])),
           (2, "insert", "customers", "cu2", _payload("customers", CUST[1])),
           (3, "insert", "wallets", "wa1", _payload("wallets", WAL[0])),
           (4, "insert", "wallets", "wa2", _payload("wallets", WAL[1])),
           (5, "insert", "merchants", "me1", _payload("merchants", MER[0]))] + list(extra)
    wh = Warehouse(spark, f"{work}/wh", PAYMENTS)
    ingest(spark, f"{work}/lake", wh, events(spark, log))
    tables = dict(src)
    tables.update({t.wh_name: wh.read(t) for t in PAYMENTS.tables})
    return tables


def test_reference_profile_has_49_rules():
    rules = R.reference_rules()
    assert len(rules) == 49 and rules[0].rule_id == "V01" and rules[-1].rule_id == "V49"


def test_demo_data_is_clean(spark, work):
    res = R.evaluate(spark, R.reference_rules(), _demo(spark, work))
    assert R.violations(res) == []
    assert res.where("status = 'pass'").count() == 49


def test_negative_warehouse_balance(spark, work):
    bad = (99, "insert", "wallets", "wa9",
           '{"wallet_id": "wa9", "customer_id": "cu1", "balance": -100.00, "currency": "SEK", "status": "active",'
           ' "created_at": "2025-02-01T08:00:00", "updated_at": "2025-02-01T08:00:00"}')
    msgs = R.violations(R.evaluate(spark, R.reference_rules(), _demo(spark, work, [bad])))
    assert "wh_wallets: 1 row(s) have negative wallet balance" in msgs


def test_orphan_warehouse_wallet(spark, work):
    bad = (100, "insert", "wallets", "wa8",
           '{"wallet_id": "wa8", "customer_id": "nobody", "balance": 5.00, "currency": "SEK", "status": "active",'
           ' "created_at": "2025-02-01T08:00:00", "updated_at": "2025-02-01T08:00:00"}')
    msgs = R.violations(R.evaluate(spark, R.reference_rules(), _demo(spark, work, [bad])))
    assert any("wh_wallets.customer_id -> wh_customers.customer_id" in m for m in msgs)


def test_soft_deleted_parent_breaks_active_fk(spark, work):
    msgs = R.violations(R.evaluate(spark, R.reference_rules(), _demo(spark, work, [
        (6, "delete", "customers", "cu2", "{}")])))
    assert msgs == ["wh_wallets.customer_id -> wh_customers.customer_id: 1 active warehouse row(s) violate "
                    "referential integrity"]


def test_every_reference_rule_fires(spark):
    """One bad row per rule family; every one of the 49 rules reports."""
    bad_c = [("cu1", None, None, None, None, D), ("cu1", "x", "y", "weird", D, D)]
    bad_w = [("wa1", None, None, None, None, D, D), ("wa1", "ghost", Decimal("-1.00"), "SEK", "odd", D, D)]
    bad_m = [("me1", "m", "e", "active", D), ("me1", "m", "e", "active", D)]
    bad_t = [("tx1", None, None, None, None, None, None, None, D, None),
             ("tx1", "ghost", "nomer", Decimal("-2.00"), Decimal("-1.00"), "sideways", "lost", None, D2, D)]
    bad_l = [("le1", None, None, None, None, Decimal("1.00"), D), ("le1", "ghost", "ghost", "both", Decimal("1.00"),
                                                                    Decimal("1.00"), D)]
    def with_null_row(rows):
        return rows + [tuple(None for _ in rows[0])]
    src = source_tables(spark, customers=with_null_row(bad_c), wallets=with_null_row(bad_w), merchants=bad_m,
                        transactions=with_null_row(bad_t), ledger_entries=with_null_row(bad_l))
    tables = dict(src)
    for t in PAYMENTS.tables:
        tables[t.wh_name] = src[t.name].selectExpr("*", "CAST(0 AS BIGINT) AS _cdc_seq", "false AS _deleted")
    res = R.evaluate(spark, R.reference_rules(), tables)
    failing = {r.rule_id for r in res.where("status = 'fail'").collect()}
    # V08 (wh merchants pk) and the wh fk rules fire too because the copies hold the same bad rows.
    assert failing == {f"V{i:02d}" for i in range(1, 50)}


def test_missing_table_not_evaluated(spark):
    res = R.evaluate(spark, R.reference_rules(), source_tables(spark))
    st = {r.rule_id: r.status for r in res.collect()}
    assert st["V06"] == "not_evaluated" and st["V01"] == "pass"
    strict = R.evaluate(spark, R.reference_rules(), source_tables(spark), strict=True)
    assert strict.where("rule_id = 'V06'").first().status == "fail"


def test_contract_rules_cover_both_layers(spark):
    src = R.contract_rules(PAYMENTS, "source")
    wh = R.contract_rules(PAYMENTS, "warehouse")
    assert len(src) == len(wh)
    assert any(r.rule_type == "fk_active" and r.table == "wh_ledger_entries" and r.column == "wallet_id" for r in wh)
    assert any(r.rule_type == "enum" and r.table == "merchants" for r in src)


def test_quarantine_rejects_source_ddl_violations(spark):
    wallets = source_tables(spark, wallets=[("wa1", "cu1", Decimal("-50.00"), "SEK", "active", D, D),
                                            ("wa2", "cu1", Decimal("5.00"), "SEK", "active", D, D)])["wallets"]
    txns = source_tables(spark, transactions=[("tx1", "wa2", None, Decimal("5.00"), Decimal("0.00"), "debit",
                                               "teleported", None, D, None)])["transactions"]
    good, bad = R.split(R.quarantine(wallets, PAYMENTS.table("wallets")))
    assert [r.wallet_id for r in bad.collect()] == ["wa1"] and good.count() == 1
    assert bad.first()._reasons == ["nonnegative:balance_nonnegative"]
    q = R.quarantine(txns, PAYMENTS.table("transactions"), {"wallets": wallets}).first()
    assert q._reasons == ["enum:status"]


def test_transitions_totals_freshness_completeness(spark):
    ev = events(spark, [(1, "insert", "accounts", "1", {}), (2, "insert", "accounts", "1", {}),
                        (3, "delete", "accounts", "1", {}), (4, "update", "accounts", "1", {})])
    from tidemark.contracts import FEED
    v = {(r.from_value, r.to_value): r.violations for r in R.transition_violations(ev, FEED).collect()}
    assert v == {("insert", "insert"): 1, ("delete", "update"): 1}
    fr = R.freshness(ev).first()
    assert fr.lag_seconds == 0 and fr.events == 4
    tx = source_tables(spark, transactions=TXN)["transactions"]
    le = source_tables(spark, ledger_entries=LED + [("le2", "tx1", "wa1", "credit", Decimal("2.00"),
                                                     Decimal("92.00"), D)])["ledger_entries"]
    tot = R.totals_mismatch(tx, "transaction_id", tx["amount"], le, "transaction_id", le["amount"]).first()
    assert (tot.parents, tot.mismatched) == (1, 1)
    comp = R.completeness(le, tx, ["transaction_id"]).first()
    assert (comp.missing_in_target, comp.extra_in_target) == (0, 0)


def test_consistency_detects_difference(spark, work):
    tables = _demo(spark, work)
    wh = tables["wh_customers"]
    assert R.consistency(wh, wh).first().only_in_warehouse == 0
    assert R.consistency(wh, fm.active(wh).limit(1)).first().only_in_warehouse == 1
