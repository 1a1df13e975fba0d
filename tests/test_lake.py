"""Lake append: idempotence, in-batch duplicates, conflicts, door checks."""
import pytest

from helpers import events
from tidemark.operators import lake as lm


def test_append_two_rows_with_metadata(spark, work):
    path = f"{work}/lake"
    ev = events(spark, [(1, "insert", "customers", "c1", {"customer_id": "c1", "name": "Ada"}),
                        (2, "insert", "customers", "c2", {"customer_id": "c2", "name": "Bo"})])
    res = lm.append(spark, path, ev)
    assert res.written == 2 and res.batch_id == 1
    rows = {r.sequence: r for r in lm.read_lake(spark, path).collect()}
    assert rows[1].table_name == "customers" and rows[2].primary_key == "c2"
    assert rows[1].operation == "insert" and rows[1]._ingest_batch == 1 and rows[1]._restore_no == 0


def test_reappend_writes_nothing(spark, work):
    path = f"{work}/lake"
    ev = events(spark, [(7, "insert", "customers", "c1", {"customer_id": "c1"})])
    assert lm.append(spark, path, ev).written == 1
    again = lm.append(spark, path, ev)
    assert again.written == 0 and again.already_in_lake == 1
    assert lm.read_lake(spark, path).count() == 1


def test_duplicate_inside_one_batch(spark, work):
    path = f"{work}/lake"
    row = (1, "insert", "customers", "c1", {"customer_id": "c1"})
    res = lm.append(spark, path, events(spark, [row, row]))
    assert res.written == 1 and res.duplicates_in_batch == 1


def test_conflicting_duplicate_first_writer_wins(spark, work):
    path = f"{work}/lake"
    lm.append(spark, path, events(spark, [(1, "insert", "customers", "c1", {"name": "first"})]))
    res = lm.append(spark, path, events(spark, [(1, "insert", "customers", "c1", {"name": "second"})]))
    assert res.written == 0 and res.conflicts == 1
    assert lm.read_lake(spark, path).first().data == '{"name": "first"}'


def test_empty_input_writes_nothing(spark, work):
    path = f"{work}/lake"
    res = lm.append(spark, path, events(spark, [(1, "insert", "t", "1", {})]).limit(0))
    assert res.written == 0 and res.received == 0
    assert lm.committed_batches(spark, path) == []


def test_unknown_table_is_kept(spark, work):
    path = f"{work}/lake"
    lm.append(spark, path, events(spark, [(1, "insert", "audit_log", "a1", {"x": 1})]))
    assert lm.read_lake(spark, path).first().table_name == "audit_log"


def test_null_lake_column_rejected(spark, work):
    from tidemark.contracts import LAKE_SCHEMA
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in LAKE_SCHEMA.fields])
    df = spark.createDataFrame([(1, "insert", "t", None, "{}", None)], schema)
    with pytest.raises(lm.LakeDoorError):
        lm.append(spark, f"{work}/lake", df)


def test_sequence_health(spark):
    ev = events(spark, [(1, "insert", "t", "1", {"a": 1}), (1, "insert", "t", "1", {"a": 2}),
                        (2, "update", "t", "1", {"a": 3}), (2, "update", "t", "1", {"a": 3}),
                        (5, "update", "t", "1", {"a": 4})])
    h = lm.sequence_health(ev).first().asDict()
    assert h == {"events": 5, "distinct_sequences": 3, "min_sequence": 1, "max_sequence": 5,
                 "duplicate_sequences": 2, "conflicting_sequences": 1, "missing_sequences": 2}


def test_register_lake_table(spark, work):
    path = f"{work}/lake"
    lm.append(spark, path, events(spark, [(1, "insert", "customers", "c1", {"customer_id": "c1"}),
                                          (2, "insert", "wallets", "w1", {"wallet_id": "w1"})]))
    name = lm.register_table(spark, path, "lake_reg_test")
    assert spark.sql(f"SELECT count(*) FROM {name} WHERE table_name = 'wallets'").first()[0] == 1


def test_source_conform_applies_defaults_only_when_absent(spark):
    from decimal import Decimal
    from tidemark.contracts import PAYMENTS
    from tidemark.sources.source_tables import conform
    df = spark.createDataFrame([("tx1", "w1", Decimal("5.00"), "debit", "pending")],
                               "transaction_id string, wallet_id string, amount decimal(18,2), direction string, "
                               "status string")
    row = conform(df, PAYMENTS.table("transactions")).first()
    assert row.fee == Decimal("0.00") and row.merchant_id is None
    df2 = df.withColumn("fee", df.amount.cast("decimal(18,2)") * None)
    assert conform(df2, PAYMENTS.table("transactions")).first().fee is None
