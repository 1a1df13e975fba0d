"""Schema safety: compare sources and change payloads with the contract and
stop ingestion before anything is written when they break it.

* ``check_schema`` (G1) keeps the reference's message formats.
* ``assert_schema_compatible`` (G2) raises with a ``STOP-THE-LINE`` message.
* ``schema_report`` (G3) adds type and domain checks as rows, and
  ``assert_source_compatible`` stops on type, nullability, domain and key changes.
* ``payload_key_drift`` / ``payload_type_drift`` / ``key_agreement``
  (G4-G6) look inside JSON payloads of a feed.
* ``assert_payloads_compatible`` runs G4-G6 as ONE aggregate over a batch
  and raises before the lake write.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import Contract, TableContract
from tidemark.functions import payload

logger = logging.getLogger(__name__)


# Message formats of the schema contract check and the
# stop-the-line error (tests and log consumers match on them).
MISSING_TABLE = "{table}: table missing or describe failed — {reason}"
MISSING_COLUMN = "{table}.{column}: required column missing from source table (dropped or renamed)"
STOP_HEADER = "STOP-THE-LINE: Incompatible source schema changes detected!"
STOP_ITEM = "  ✗ {problem}"


class SchemaIncompatibilityError(Exception):
    """Source or payload shape breaks the declared contract."""


# ---------------------------------------------------------------- G1, G2 ----
def check_schema(tables: dict[str, DataFrame | None], contract: Contract) -> list[str]:
    """Per contract table: missing table -> one message; each expected column
    missing -> one message.  Extra columns are fine.  Case-sensitive."""
    problems: list[str] = []
    for t in contract.tables:
        df = tables.get(t.name)
        if df is None:
            problems.append(MISSING_TABLE.format(table=t.name, reason="no such table"))
            continue
        actual = set(df.columns)
        for col in t.column_names:
            if col not in actual:
                problems.append(MISSING_COLUMN.format(table=t.name, column=col))
    return problems


def stop_message(problems: list[str]) -> str:
    return "\n".join([STOP_HEADER] + [STOP_ITEM.format(problem=p) for p in problems])


def assert_schema_compatible(tables: dict[str, DataFrame | None], contract: Contract) -> None:
    problems = check_schema(tables, contract)
    if problems:
        msg = stop_message(problems)
        logger.error(msg)
        raise SchemaIncompatibilityError(msg)


def catalog_tables(spark: SparkSession, names: list[str]) -> dict[str, DataFrame | None]:
    """Look tables up in the session catalog (``None`` when absent)."""
    out = {}
    for n in names:
        out[n] = spark.table(n) if spark.catalog.tableExists(n) else None
    return out


# ---------------------------------------------------------------------- G3 --
def schema_report(tables: dict[str, DataFrame | None], contract: Contract) -> DataFrame:
    """One row per problem: missing table/column, type change, and per column
    the count of values outside the declared domain (one scan per table,
    all columns in one aggregate).  Columns: table_name, column_name,
    problem, expected, actual, rows."""
    spark = next((df.sparkSession for df in tables.values() if df is not None), SparkSession.getActiveSession())
    rows: list[tuple] = []
    scans: list[DataFrame] = []
    for t in contract.tables:
        df = tables.get(t.name)
        if df is None:
            rows.append((t.name, None, "missing_table", None, None, None))
            continue
        actual = {f.name: f.dataType for f in df.schema.fields}
        aggs = []
        for c in t.columns:
            if c.name not in actual:
                rows.append((t.name, c.name, "missing_column", c.dtype.simpleString(), None, None))
                continue
            if actual[c.name] != c.dtype:
                rows.append((t.name, c.name, "type_changed", c.dtype.simpleString(),
                             actual[c.name].simpleString(), None))
            if c.domain:
                aggs.append(F.struct(F.lit(c.name).alias("column_name"),
                                     F.lit(",".join(c.domain)).alias("expected"),
                                     F.count_if(~F.col(c.name).isin(*c.domain)).alias("rows")))
        if aggs:
            scans.append(df.agg(F.array(*aggs).alias("d"))
                         .select(F.explode("d").alias("d"))
                         .select(F.lit(t.name).alias("table_name"), F.col("d.column_name"),
                                 F.lit("outside_domain").alias("problem"), F.col("d.expected"),
                                 F.lit(None).cast("string").alias("actual"), F.col("d.rows")))
    schema = ("table_name string, column_name string, problem string, expected string, "
              "actual string, rows bigint")
    out = spark.createDataFrame(rows, schema)
    for s in scans:
        out = out.unionByName(s)
    return out


def source_problems(tables: dict[str, DataFrame | None], contract: Contract,
                    names: list[str] | None = None) -> list[str]:
    """Every incompatible change of the sources: columns gone or retyped, NULL in
    a required column, values outside a domain, keys that repeat, references
    without a parent.  One aggregate per table for its rows, one grouping per
    key and reference."""
    wanted = [t for t in contract.tables if names is None or t.name in names]
    problems = check_schema({t.name: tables.get(t.name) for t in wanted}, Contract(tuple(wanted), contract.name))
    for t in wanted:
        df = tables.get(t.name)
        if df is None:
            continue
        actual = {f.name: f.dataType for f in df.schema.fields}
        counts = []
        for c in t.columns:
            if c.name not in actual:
                continue
            if actual[c.name] != c.dtype:
                problems.append(f"{t.name}.{c.name}: type {actual[c.name].simpleString()}, "
                                f"contract {c.dtype.simpleString()}")
            if not c.nullable or c.name in t.pk:
                counts.append((f"{t.name}.{c.name}: null value(s) in a required column", F.col(c.name).isNull()))
            if c.domain:
                counts.append((f"{t.name}.{c.name}: value(s) outside the domain", ~F.col(c.name).isin(*c.domain)))
        if counts:
            got = df.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(f"c{i}")
                           for i, (_, cond) in enumerate(counts)]).first()
            problems += [f"{what} ({got[i]} row(s))" for i, (what, _) in enumerate(counts) if got[i]]
        if all(k in actual for k in t.pk):
            repeated = df.groupBy(*t.pk).count().where("count > 1").agg(F.count(F.lit(1))).first()[0]
            if repeated:
                problems.append(f"{t.name}: primary key {'+'.join(t.pk)} repeats ({repeated} key(s))")
        for fk in t.fks:
            parent = tables.get(fk.parent)
            if parent is None or fk.column not in actual or fk.parent_column not in parent.columns:
                continue
            keys = df.select(F.col(fk.column).alias("_k")).where("_k is not null").distinct()
            orphans = keys.join(parent.select(F.col(fk.parent_column).alias("_k")), "_k", "left_anti").count()
            if orphans:
                problems.append(f"{t.name}.{fk.column}: {orphans} value(s) without a row in {fk.parent}")
    return problems


def assert_source_compatible(tables: dict[str, DataFrame | None], contract: Contract,
                             names: list[str] | None = None) -> None:
    """G2 + G3: stop the line on any incompatible change of the sources."""
    problems = source_problems(tables, contract, names)
    if problems:
        msg = stop_message(problems)
        logger.error(msg)
        raise SchemaIncompatibilityError(msg)


# ------------------------------------------------------------------ G4-G6 ---
def _per_table(contract: Contract, fn) -> Column:
    """CASE table_name WHEN t THEN fn(t) ... END (only the row's own table
    branch is evaluated, so each payload is parsed once with its schema)."""
    expr = None
    for t in contract.tables:
        branch = fn(t)
        expr = F.when(F.col("table_name") == t.name, branch) if expr is None else expr.when(
            F.col("table_name") == t.name, branch)
    return expr


def payload_key_drift(feed: DataFrame, contract: Contract) -> DataFrame:
    """Keys sent but unknown to the contract, and contract keys missing
    from upserts; per (table, operation, key): events and first sequence.
    Events of tables outside the contract are reported once per table."""
    keys = payload.keys("data")
    known = _per_table(contract, lambda t: F.array(*[F.lit(c) for c in t.column_names]))
    ev = feed.select("sequence", "table_name", "operation", keys.alias("_k"), known.alias("_known"))
    unknown = F.transform(F.array_except(F.coalesce("_k", F.array().cast("array<string>")), "_known"),
                          lambda k: F.struct(k.alias("key_name"), F.lit("unknown_key").alias("drift")))
    missing = F.when(F.col("operation") != "delete", F.transform(
        F.array_except("_known", F.coalesce("_k", F.array().cast("array<string>"))),
        lambda k: F.struct(k.alias("key_name"), F.lit("missing_key").alias("drift"))))
    no_table = F.when(F.col("_known").isNull(), F.array(F.struct(
        F.lit(None).cast("string").alias("key_name"), F.lit("unknown_table").alias("drift"))))
    items = F.coalesce(no_table, F.concat(unknown, F.coalesce(missing, F.array().cast(
        "array<struct<key_name:string,drift:string>>"))))
    return (ev.select("sequence", "table_name", "operation", F.explode(items).alias("i"))
            .groupBy("table_name", "operation", F.col("i.key_name").alias("key_name"),
                     F.col("i.drift").alias("drift"))
            .agg(F.count(F.lit(1)).alias("events"), F.min("sequence").alias("first_sequence")))


def payload_type_drift(feed: DataFrame, contract: Contract) -> DataFrame:
    """Per (table, column) count of values that do not parse as the
    contract type (PERMISSIVE parsing would silently turn them into NULL)."""
    parts = []
    for t in contract.tables:
        ev = feed.where(F.col("table_name") == t.name)
        parsed = ev.select("sequence", payload.typed("data", t).alias("_p"),
                           F.from_json("data", RAW_MAP).alias("_m")).select(
            "sequence", "_p", F.map_keys("_m").alias("_k"),
            *[F.col("_m").getItem(c).alias(f"_r_{c}") for c in t.column_names])
        aggs = []
        for c in t.column_names:
            bad = payload.bad_value(F.col("_p").getField(c), F.col("_k"), F.col(f"_r_{c}"), t.column(c).dtype, c)
            aggs.append(F.struct(F.lit(c).alias("column_name"), F.count_if(bad).alias("bad_values"),
                                 F.min(F.when(bad, F.col("sequence"))).alias("first_sequence")))
        parts.append(parsed.agg(F.array(*aggs).alias("a")).select(
            F.lit(t.name).alias("table_name"), F.explode("a").alias("a")).select(
            "table_name", "a.column_name", "a.bad_values", "a.first_sequence"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def key_agreement(feed: DataFrame, contract: Contract) -> DataFrame:
    """Per table, upserts whose payload key differs from ``primary_key``."""
    def pk_text(t: TableContract) -> Column:
        return payload.typed("data", t).getField(t.single_pk).cast("string")
    payload_pk = _per_table(contract, pk_text)
    ev = feed.where(F.col("table_name").isin(*contract.names) & (F.col("operation") != "delete"))
    return ev.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("upserts"),
        F.count_if(payload_pk.isNotNull() & (payload_pk != F.col("primary_key"))).alias("mismatches"),
        F.count_if(payload_pk.isNull()).alias("missing_key"))


GATE_CHECKS = ("gate_unknown_keys", "gate_bad_types", "gate_pk_mismatch", "gate_malformed", "gate_missing_pk")
RAW_MAP = "map<string,string>"


def gate_prepare(contract: Contract):
    """Projection the gate aggregates read: each payload parsed once as a
    text map (key presence and raw text of every field) and once typed with
    its own table's schema (only that CASE branch is evaluated)."""
    def prepare(df: DataFrame) -> DataFrame:
        typed = [F.when(F.col("table_name") == t.name, payload.typed("data", t)).alias(f"_gt{i}")
                 for i, t in enumerate(contract.tables)]
        return df.select("*", F.from_json("data", RAW_MAP).alias("_gm"), *typed)
    return prepare


def gate_conditions(contract: Contract) -> dict[str, Column]:
    """G4-G6 as one condition per check over ``gate_prepare`` output: unknown
    payload keys, values unusable as the contract type, payload key !=
    primary_key, upserts whose payload is no JSON object, inserts without
    their key.  The raw-text map is lossy for big numbers, which does not
    matter here: it is only used for presence and number-format checks."""
    keys = F.map_keys("_gm")
    by_table = {t.name: i for i, t in enumerate(contract.tables)}

    def typed(t: TableContract) -> Column:
        return F.col(f"_gt{by_table[t.name]}")

    def unknown(t):
        return F.size(F.array_except(keys, F.array(*[F.lit(c) for c in t.column_names]))) > 0

    def bad_type(t):
        cond = F.lit(False)
        for c in t.column_names:
            cond = cond | payload.bad_value(typed(t).getField(c), keys, F.col("_gm").getItem(c),
                                            t.column(c).dtype, c)
        return cond

    def pk_mismatch(t):
        v = typed(t).getField(t.single_pk).cast("string")
        return (F.col("operation") != "delete") & v.isNotNull() & (v != F.col("primary_key"))

    def malformed(t):
        return (F.col("operation") != "delete") & payload.keys("data").isNull()

    def missing_pk(t):
        return (F.col("operation") == "insert") & typed(t).getField(t.single_pk).isNull()

    return {name: F.coalesce(_per_table(contract, fn), F.lit(False))
            for name, fn in zip(GATE_CHECKS, (unknown, bad_type, pk_mismatch, malformed, missing_pk))}


def gate_aggs(contract: Contract) -> list[Column]:
    """The gate's conditions as counts, for one aggregate over a batch."""
    return [F.count_if(cond).alias(name) for name, cond in gate_conditions(contract).items()]


def raise_if_gate_failed(counts: dict[str, int]) -> None:
    problems = [f"{k.removeprefix('gate_')}: {counts[k]} event(s)" for k in GATE_CHECKS if counts.get(k)]
    if problems:
        msg = stop_message([f"payload {p}" for p in problems])
        logger.error(msg)
        raise SchemaIncompatibilityError(msg)


def assert_payloads_compatible(feed: DataFrame, contract: Contract) -> None:
    """Stop-the-line gate for a batch: one aggregate, no write."""
    raise_if_gate_failed(gate_prepare(contract)(feed).agg(*gate_aggs(contract)).first().asDict())
