"""Dataset catalog (M1-M6).

* ``build_document`` (M1): the catalog document for a contract's lake and
  warehouse datasets, generated from the contract so it cannot drift from
  the code that writes those datasets.
* ``validate`` (M2, M3): structural checks of a catalog file as DataFrame
  rules over its datasets and columns.  The document is read as raw JSON
  text so that a missing key and an explicit null stay distinguishable.
* ``drift`` (M4): published name / type / nullability against the data,
  including a NULL count (one aggregate per dataset) for every column the
  catalog publishes as not nullable.
* ``discover`` (M5), ``profile`` (M6), ``register`` (Spark catalog tables
  with comments and table properties).
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import INGEST_BATCH, CDC_SEQ, DELETED, LAKE_SCHEMA, Contract
from tidemark.operators import lake
from tidemark.sources import fs

# The catalog's required dataset fields, column attributes,
# allowed layers and validation messages (the catalog format and message
# texts the reference publishes; {d} dataset, {c} column, {f} field, {x} value).
DATASET_FIELDS = ["name", "layer", "table_name", "owner", "intended_audience", "update_cadence",
                  "description", "schema"]
COLUMN_FIELDS = ["name", "type", "description", "nullable"]
LAYERS = ["lake", "warehouse"]
MSG = {
    "not_found": "Catalog file not found at path: {x}",
    "unparsable": "Failed to parse JSON catalog file: {x}",
    "no_version": "Catalog missing root field: 'version'",
    "no_datasets": "Catalog missing root list field: 'datasets'",
    "empty": "Catalog 'datasets' list is empty.",
    "missing_field": "Dataset '{d}' missing required field: '{f}'",
    "bad_layer": "Dataset '{d}' has invalid layer '{x}'. Must be one of: ['lake', 'warehouse']",
    "empty_schema": "Dataset '{d}' schema column list is empty.",
    "missing_attr": "Dataset '{d}' column '{c}' missing required attribute: '{f}'",
    "schema_not_list": "Dataset '{d}' field 'schema' must be a list of columns.",
    "no_lake": "Catalog contains no 'lake' datasets.",
    "no_warehouse": "Catalog contains no 'warehouse' datasets.",
}

ENTRY_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()), T.StructField("owner", T.StringType()),
    T.StructField("intended_audience", T.StringType()), T.StructField("update_cadence", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("schema", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("type", T.StringType()),
        T.StructField("description", T.StringType()), T.StructField("nullable", T.BooleanType())]))),
])


# ------------------------------------------------------------------- M1 ----
def _column(name: str, dtype: T.DataType, nullable: bool, description: str) -> dict:
    return {"name": name, "type": dtype.simpleString(), "description": description, "nullable": nullable}


def build_document(contract: Contract, owner: str = "data platform", audience: str = "analysts, engineers",
                   lake_name: str = "lake_cdc_events", version: str = "1.0.0") -> dict:
    lake_cols = [_column(f.name, f.dataType, f.nullable, f"change event field {f.name}") for f in LAKE_SCHEMA.fields]
    datasets = [{
        "name": lake_name, "layer": "lake", "table_name": lake_name, "owner": owner,
        "intended_audience": audience, "update_cadence": "streaming, append-only",
        "description": "Every change event of every source table, stored once, never modified.",
        "schema": lake_cols,
    }]
    for t in contract.tables:
        # Warehouse rows may hold NULL in any non-key column (absent payload
        # keys fold to NULL), so only the key is published as not nullable.
        cols = [_column(c.name, c.dtype, c.name not in t.pk, f"{t.name}.{c.name}") for c in t.columns]
        cols += [_column(CDC_SEQ, T.LongType(), False, "sequence of the last change applied to the row"),
                 _column(DELETED, T.BooleanType(), False, "true once the source row was deleted")]
        datasets.append({
            "name": t.wh_name, "layer": "warehouse", "table_name": t.wh_name, "owner": owner,
            "intended_audience": audience, "update_cadence": "per micro-batch",
            "description": t.description or f"current state of {t.name}",
            "schema": cols,
        })
    return {"version": version, "catalog_name": f"{contract.name}_catalog",
            "description": f"Lake and warehouse datasets of {contract.name}", "datasets": datasets}


def write_document(spark: SparkSession, path: str, doc: dict) -> None:
    fs.write_text_atomic(spark, path, json.dumps(doc, indent=2))


def entries(spark: SparkSession, path: str) -> DataFrame:
    """One row per dataset of a catalog file (typed)."""
    doc = spark.read.option("multiLine", True).schema(
        T.StructType([T.StructField("version", T.StringType()),
                      T.StructField("datasets", T.ArrayType(ENTRY_SCHEMA))])).json(path)
    return doc.select(F.posexplode("datasets").alias("ordinal", "d")).select("ordinal", "d.*")


def columns(entries_df: DataFrame) -> DataFrame:
    """One row per published column: dataset, layer, column, type, nullable."""
    return entries_df.select(F.col("name").alias("dataset"), "layer",
                             F.posexplode("schema").alias("position", "c")).select(
        "dataset", "layer", "position", F.col("c.name").alias("column_name"),
        F.col("c.type").alias("published_type"), F.col("c.nullable").alias("published_nullable"))


def discover(entries_df: DataFrame, layer: str | None = None, owner: str | None = None,
             column: str | None = None) -> DataFrame:
    """M5: datasets by layer, owner (substring, case-insensitive) or column."""
    out = entries_df
    if layer:
        out = out.where(F.col("layer") == layer)
    if owner:
        out = out.where(F.lower("owner").contains(owner.lower()))
    if column:
        out = out.where(F.exists("schema", lambda c: c.getField("name") == column))
    return out


# --------------------------------------------------------------- M2, M3 ----
def _msg(key: str, **parts: Column | str) -> Column:
    """Message column from a MSG template; placeholders filled with columns."""
    pieces: list[Column] = []
    for tok in re.split(r"(\{[a-z]\})", MSG[key]):
        if not tok:
            continue
        name = tok[1:-1] if re.fullmatch(r"\{[a-z]\}", tok) else None
        if name is None:
            pieces.append(F.lit(tok))
        else:
            v = parts[name]
            pieces.append(F.lit(v) if isinstance(v, str) else v)
    return F.concat(*pieces)


def _jstr(doc: Column, path: str) -> Column:
    return F.get_json_object(doc, path)


def _present(keys: Column, name: str) -> Column:
    return F.coalesce(F.array_contains(keys, name), F.lit(False))


def validate(spark: SparkSession, path: str) -> DataFrame:
    """Errors of a catalog file, in document order: (ordinal, message).
    Empty result = valid."""
    schema = "ordinal bigint, message string"
    if not fs.exists(spark, path):
        return spark.createDataFrame([(0, MSG["not_found"].format(x=path))], schema)
    doc = spark.read.text(path, wholetext=True).select(F.col("value").alias("doc"))
    keys = F.json_object_keys("doc")
    root = doc.select("doc", keys.alias("k"))
    parsed_ok = F.col("k").isNotNull()
    ds_raw = _jstr(F.col("doc"), "$.datasets")
    is_list = F.coalesce(F.ltrim(ds_raw).startswith("["), F.lit(False))
    root = root.select("doc", "k", parsed_ok.alias("ok"), is_list.alias("is_list"),
                       F.from_json(ds_raw, "array<string>").alias("ds"))

    errors: list[DataFrame] = []

    def err(df: DataFrame, ordinal: Column, message: Column) -> None:
        errors.append(df.select(ordinal.cast("bigint").alias("ordinal"), message.alias("message")))

    bad = root.where(~F.col("ok"))
    err(bad, F.lit(0), _msg("unparsable", x="not a JSON object"))
    good = root.where(F.col("ok"))
    err(good.where(~_present(F.col("k"), "version")), F.lit(1), _msg("no_version"))
    err(good.where(~F.col("is_list")), F.lit(2), _msg("no_datasets"))
    listed = good.where(F.col("is_list"))
    err(listed.where(F.size("ds") == 0), F.lit(3), _msg("empty"))

    ds = listed.select(F.posexplode("ds").alias("i", "d")).select(
        "i", "d", F.json_object_keys("d").alias("dk"))
    ds_name = F.coalesce(_jstr(F.col("d"), "$.name"), F.concat(F.lit("dataset["), F.col("i"), F.lit("]")))
    ds = ds.withColumn("dn", ds_name)
    base = (F.col("i") + 1) * 1000
    for j, f in enumerate(DATASET_FIELDS):
        v = _jstr(F.col("d"), f"$.{f}")
        missing = ~_present(F.col("dk"), f) | v.isNull() | (v == "")
        err(ds.where(missing), base + j, _msg("missing_field", d=F.col("dn"), f=f))
    layer = _jstr(F.col("d"), "$.layer")
    err(ds.where(~F.coalesce(layer.isin(*LAYERS), F.lit(False))), base + 100,
        _msg("bad_layer", d=F.col("dn"), x=F.coalesce(layer, F.lit("None"))))
    sraw = _jstr(F.col("d"), "$.schema")
    s_list = F.coalesce(F.ltrim(sraw).startswith("["), F.lit(False))
    err(ds.where(~s_list), base + 900, _msg("schema_not_list", d=F.col("dn")))
    sc = ds.where(s_list).select("i", "dn", F.from_json(sraw, "array<string>").alias("cols"))
    err(sc.where(F.size("cols") == 0), base + 200, _msg("empty_schema", d=F.col("dn")))
    cols = sc.select("i", "dn", F.posexplode("cols").alias("ci", "c")).select(
        "i", "dn", "ci", "c", F.json_object_keys("c").alias("ck"))
    col_name = F.coalesce(_jstr(F.col("c"), "$.name"), F.concat(F.lit("col["), F.col("ci"), F.lit("]")))
    for j, f in enumerate(COLUMN_FIELDS):
        err(cols.where(~_present(F.col("ck"), f)), base + 300 + F.col("ci") * 10 + j,
            _msg("missing_attr", d=F.col("dn"), c=col_name, f=f))
    counts = listed.select(F.col("ds")).select(
        F.size(F.filter("ds", lambda d: F.get_json_object(d, "$.layer") == "lake")).alias("lake"),
        F.size(F.filter("ds", lambda d: F.get_json_object(d, "$.layer") == "warehouse")).alias("wh"))
    err(counts.where(F.col("lake") == 0), F.lit(10 ** 12), _msg("no_lake"))
    err(counts.where(F.col("wh") == 0), F.lit(10 ** 12 + 1), _msg("no_warehouse"))
    out = errors[0]
    for e in errors[1:]:
        out = out.unionByName(e)
    return out


def validation_errors(spark: SparkSession, path: str) -> list[str]:
    return [r["message"] for r in validate(spark, path).orderBy("ordinal").collect()]


# ------------------------------------------------------------------- M4 ----
_SQL_TYPES = {"varchar": "string", "text": "string", "integer": "int", "int": "int", "bigint": "bigint",
              "boolean": "boolean", "double": "double", "timestamp": "timestamp_ntz",
              "timestamp_ntz": "timestamp_ntz", "string": "string", "long": "bigint"}


def normalize_type(name: str | None) -> str | None:
    """Published type text -> Spark type name (SQL spellings accepted)."""
    if name is None:
        return None
    n = name.strip().lower().replace(" ", "")
    m = re.fullmatch(r"(decimal|numeric)\((\d+),(\d+)\)", n)
    if m:
        return f"decimal({m.group(2)},{m.group(3)})"
    return _SQL_TYPES.get(n, n)


def drift(column_entries: DataFrame, datasets: dict[str, DataFrame]) -> DataFrame:
    """Published columns against the data: one row per published column with
    actual type, NULL count (for columns published not nullable) and a
    verdict: missing / type / nulls / ok."""
    spark = column_entries.sparkSession
    published = column_entries.select("dataset", "column_name", "published_type", "published_nullable").collect()
    meta_rows, scans = [], []
    by_ds: dict[str, list] = {}
    for r in published:
        by_ds.setdefault(r["dataset"], []).append(r)
    for ds, cols in by_ds.items():
        df = datasets.get(ds)
        actual = {f.name: f.dataType.simpleString() for f in df.schema.fields} if df is not None else {}
        aggs = []
        for r in cols:
            a_type = actual.get(r["column_name"])
            meta_rows.append((ds, r["column_name"], r["published_type"], normalize_type(r["published_type"]),
                              a_type, r["published_nullable"]))
            if a_type is not None and r["published_nullable"] is False:
                aggs.append(F.struct(F.lit(r["column_name"]).alias("column_name"),
                                     F.count_if(F.col(r["column_name"]).isNull()).alias("null_rows")))
        if aggs and df is not None:
            scans.append(df.agg(F.array(*aggs).alias("a")).select(F.lit(ds).alias("dataset"),
                                                                  F.explode("a").alias("a"))
                         .select("dataset", "a.column_name", "a.null_rows"))
    meta = spark.createDataFrame(meta_rows, "dataset string, column_name string, published_type string, "
                                            "_norm string, actual_type string, published_nullable boolean")
    nulls = None
    for s in scans:
        nulls = s if nulls is None else nulls.unionByName(s)
    if nulls is None:
        nulls = spark.createDataFrame([], "dataset string, column_name string, null_rows bigint")
    # Both sides hold one row per published column: bounded by the catalog size.
    j = meta.join(F.broadcast(nulls), ["dataset", "column_name"], "left")
    verdict = (F.when(F.col("actual_type").isNull(), "missing")
               .when(F.col("_norm") != F.col("actual_type"), "type")
               .when(F.coalesce(F.col("null_rows"), F.lit(0)) > 0, "nulls").otherwise("ok"))
    return j.select("dataset", "column_name", "published_type", "actual_type", "published_nullable",
                    "null_rows", verdict.alias("drift"))


# ------------------------------------------------------------------- M6 ----
def profile(datasets: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """Row count, active rows, highest sequence and newest capture time per
    dataset (one aggregate each)."""
    out = None
    for name, (layer, df) in datasets.items():
        if "sequence" in df.columns:
            seq, active = F.max("sequence"), F.lit(None).cast("long")
            cap = F.max("captured_at")
        else:
            seq, active = F.max(CDC_SEQ), F.count_if(~F.col(DELETED))
            cap = F.lit(None).cast("timestamp_ntz")
        p = df.agg(F.lit(name).alias("dataset"), F.lit(layer).alias("layer"),
                   F.count(F.lit(1)).alias("rows"), active.cast("long").alias("active_rows"),
                   seq.cast("long").alias("max_sequence"), cap.alias("max_captured_at"))
        out = p if out is None else out.unionByName(p)
    return out


def register(spark: SparkSession, doc: dict, locations: dict[str, str], database: str | None = None) -> list[str]:
    """Expose datasets in the Spark catalog as external Parquet tables with
    the catalog's descriptions as table/column comments and its metadata as
    table properties.  ``locations``: dataset name -> current data path.
    Tables go to one database per layer (``lake``, ``warehouse``) unless
    ``database`` names one for all."""
    made = []
    for d in doc["datasets"]:
        loc = locations.get(d["name"])
        if loc is None:
            continue
        db = database or d["layer"]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
        cols = ", ".join(f"`{c['name']}` {c['type']} COMMENT {json.dumps(c['description'])}"
                         for c in d["schema"] if d["layer"] != "lake" or c["name"] != "table_name")
        part = f" PARTITIONED BY (`{INGEST_BATCH}`, `table_name`)" if d["layer"] == "lake" else ""
        if part:
            cols += f", `{INGEST_BATCH}` bigint COMMENT 'append that wrote it', `table_name` string COMMENT 'source table'"
        # "owner" is a reserved Spark table property, so the catalog owner is
        # stored as data_owner.
        props = ", ".join(f"{json.dumps(prop)} = {json.dumps(str(d[k]))}" for prop, k in (
            ("layer", "layer"), ("data_owner", "owner"), ("intended_audience", "intended_audience"),
            ("update_cadence", "update_cadence")))
        table = f"`{db}`.`{d['name']}`"
        if part and lake.read_log(spark, loc).compactions:      # a view over the compacted folders and the rest
            lake.register_table(spark, loc, f"{db}.{d['name']}")
            made.append(table)
            continue
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet{part} LOCATION '{loc}' "
                  f"COMMENT {json.dumps(d['description'])} TBLPROPERTIES ({props})")
        if part:
            spark.sql(f"MSCK REPAIR TABLE {table}")
        made.append(table)
    return made


def shipped_catalog_path() -> str:
    """The catalog document shipped for the payments contract."""
    from pathlib import Path
    return str(Path(__file__).resolve().parents[1] / "catalog" / "payments_catalog.json")
