"""Small builders for change events and payment-system rows used by tests."""
from __future__ import annotations

import json
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.contracts import LAKE_SCHEMA, PAYMENTS

T0 = datetime(2025, 3, 1, 9, 0, 0)


def _dump(data):
    if isinstance(data, str):
        return data

    def conv(v):
        if isinstance(v, datetime):
            return v.isoformat()
        if isinstance(v, Decimal):
            return float(v)
        return v
    return json.dumps({k: conv(v) for k, v in data.items()})


def events(spark, rows):
    """rows: (sequence, operation, table, primary_key, data[, captured_at])."""
    out = []
    for r in rows:
        seq, op, table, pk, data = r[:5]
        ts = r[5] if len(r) > 5 else T0 + timedelta(minutes=int(seq))
        out.append((int(seq), op, table, str(pk), _dump(data), ts))
    return spark.createDataFrame(out, LAKE_SCHEMA)


def source_tables(spark, **rows):
    """Payment source tables as DataFrames with contract schemas; tables not
    given are empty."""
    out = {}
    for t in PAYMENTS.tables:
        data = rows.get(t.name, [])
        out[t.name] = spark.createDataFrame(data, _nullable(t.struct))
    return out


def _nullable(struct):
    from pyspark.sql import types as T
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in struct.fields])


def rows_by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def lit_ts(s):
    return F.lit(s).cast("timestamp_ntz")
