"""Data-quality rules generated from contracts, evaluated as Spark jobs.

Rule kinds and how they run:

* ``row``  - a violation predicate; all row rules of one dataset are fused
  into ONE aggregate (one scan, ``count_if`` per rule);
* ``pk`` and ``fk`` - all keyed rules of all datasets in ONE grouping: a scan of a
  dataset emits (rule, key) for every keyed rule it takes part in, as the table
  checked, as a child or as a parent, and one aggregation by (rule, key) counts
  child and parent rows.  A primary key with more than one row is a duplicate, a
  child key without a parent row is an orphan.  Partial aggregation collapses a
  hot key map-side.

So a suite scans a dataset at most twice, however many rules it has.

The result of a suite is a DataFrame (rule_id, layer, table_name,
column_name, rule_type, violations, status, message).  A dataset or column
that is missing gives status ``not_evaluated`` (``strict=True``: ``fail``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import DELETED, PAYMENTS, Contract, TableContract
from tidemark.functions.joins import left_spread

RESULT_SCHEMA = ("rule_id string, layer string, table_name string, column_name string, "
                 "rule_type string, violations bigint, status string, message string")


# SQL words that a check predicate may hold beside its columns
_SQL_WORDS = {"and", "or", "not", "is", "null", "in", "between", "like", "true", "false", "case", "when", "then",
              "else", "end", "cast", "as", "decimal", "date", "timestamp", "abs", "coalesce"}


def _columns_in(predicate: str) -> tuple[str, ...]:
    """Column names a check predicate reads, so that a missing one is reported."""
    bare = re.sub(r"'[^']*'", "", predicate)
    return tuple(sorted({w for w in re.findall(r"[A-Za-z_]\w*", bare) if w.lower() not in _SQL_WORDS}))


@dataclass(frozen=True)
class Rule:
    rule_id: str
    layer: str
    table: str
    column: str | None
    rule_type: str
    kind: str  # row | pk | fk
    message: str  # format with {table} {column} {n}
    predicate: str | None = None  # row: SQL violation predicate
    keys: tuple[str, ...] = ()  # pk: key columns / fk: (child column,)
    parent: str | None = None  # fk: parent dataset
    parent_key: str | None = None
    active_only: bool = False  # evaluate on rows with _deleted = false
    parent_active_only: bool = False
    columns_needed: tuple[str, ...] = field(default_factory=tuple)


# --------------------------------------------------------------------------
# Rule generation from a contract (L1): both layers, same rules.
# --------------------------------------------------------------------------
def contract_rules(contract: Contract, layer: str = "source") -> list[Rule]:
    wh = layer == "warehouse"
    out: list[Rule] = []
    for t in contract.tables:
        name = t.wh_name if wh else t.name

        def rid(kind: str, what: str) -> str:
            return f"{name}:{kind}:{what}"
        pk_txt = "+".join(t.pk)
        out.append(Rule(rid("pk_unique", pk_txt), layer, name, pk_txt,
                        "pk_unique_active" if wh else "pk_unique", "pk",
                        "{table}: primary key {column} non-uniqueness detected ({n} duplicate keys)",
                        keys=t.pk, active_only=wh))
        for fk in t.fks:
            parent = contract.table(fk.parent)
            out.append(Rule(rid("fk", fk.column), layer, name, fk.column,
                            "fk_active" if wh else "fk", "fk",
                            "{table}.{column} -> " + (parent.wh_name if wh else parent.name) +
                            "." + fk.parent_column + ": {n} orphaned record(s)",
                            keys=(fk.column,), parent=parent.wh_name if wh else parent.name,
                            parent_key=fk.parent_column, active_only=wh, parent_active_only=wh))
        for c in t.columns:
            if not c.nullable and c.name not in t.pk:
                out.append(Rule(rid("not_null", c.name), layer, name, c.name, "not_null", "row",
                                "{table}.{column}: {n} null value(s) violate NOT NULL constraint",
                                predicate=f"`{c.name}` IS NULL", active_only=wh, columns_needed=(c.name,)))
            if c.domain:
                dom = ", ".join("'" + v + "'" for v in c.domain)
                out.append(Rule(rid("enum", c.name), layer, name, c.name, "enum", "row",
                                "{table}.{column}: {n} row(s) contain invalid enum value outside allowed domain",
                                predicate=f"`{c.name}` NOT IN ({dom})", active_only=wh,
                                columns_needed=(c.name,)))
        for ck in t.checks:
            out.append(Rule(rid(ck.rule_type, ck.rule_id), layer, name, ck.column, ck.rule_type, "row",
                            "{table}: {n} " + (ck.message or "row(s) violate " + ck.rule_id),
                            predicate=ck.violation, active_only=wh, columns_needed=_columns_in(ck.violation)))
    return out


# --------------------------------------------------------------------------
# The reference's suite, rule for rule ("reference" profile).
# Keys, references and domains are those of the payments contract.
# Which of them the suite checks, in which order, and the message
# texts ({table} {column} {n} {parent} {allowed} are placeholders).
# --------------------------------------------------------------------------
_PK = [(t.name, t.single_pk) for t in PAYMENTS.tables]
_FK = [(t.name, fk.column, fk.parent, fk.parent_column) for t in PAYMENTS.tables for fk in t.fks]
_WH_FK = [(f"wh_{c}", fk, f"wh_{p}", pk) for c, fk, p, pk in _FK
          if (c, p) in (("wallets", "customers"), ("transactions", "wallets"), ("ledger_entries", "transactions"))]
_NOT_NULL = [("customers", ["customer_id", "name", "email", "status", "created_at"]),
             ("wallets", ["wallet_id", "customer_id", "balance", "currency", "status"]),
             ("transactions", ["transaction_id", "wallet_id", "amount", "direction", "status"]),
             ("ledger_entries", ["entry_id", "transaction_id", "wallet_id", "entry_type", "amount"])]
REF_MSG = {
    "pk_unique": "{table}: primary key {column} non-uniqueness detected ({n} duplicate keys)",
    "pk_unique_active": "{table}: primary key {column} non-uniqueness detected in active warehouse rows",
    "fk": "{table}.{column} -> {parent}: {n} orphaned record(s) violate foreign key constraint",
    "fk_active": "{table}.{column} -> {parent}: {n} active warehouse row(s) violate referential integrity",
    "not_null": "{table}.{column}: {n} null value(s) violate NOT NULL constraint",
    "nonnegative": "{table}: {n} row(s) have negative wallet balance",
    "amount_fee": "{table}: {n} row(s) have invalid transaction amount or fee",
    "time_order": "{table}: {n} row(s) have settled_at timestamp preceding created_at",
    "enum": "{table}.{column}: {n} row(s) contain invalid enum value outside allowed domain ({allowed})",
}
_BUSINESS = [
    ("wallets", "balance", "nonnegative", "balance < 0"),
    ("transactions", "amount", "amount_fee", "amount <= 0 OR fee < 0"),
    ("transactions", "settled_at", "time_order", "settled_at IS NOT NULL AND settled_at < created_at"),
]
_ENUM = [(t, c, list(PAYMENTS.table(t).column(c).domain)) for t, c in (
    ("customers", "status"), ("wallets", "status"), ("transactions", "status"), ("transactions", "direction"),
    ("ledger_entries", "entry_type"))]


def reference_rules() -> list[Rule]:
    """The reference's 49 checks, in its order, as rule objects."""
    rules: list[Rule] = []

    def add(**kw):
        rules.append(Rule(rule_id=f"V{len(rules) + 1:02d}", **kw))
    for t, pk in _PK:
        add(layer="source", table=t, column=pk, rule_type="pk_unique", kind="pk", keys=(pk,),
            message=REF_MSG["pk_unique"])
    for t, pk in _PK:
        add(layer="warehouse", table=f"wh_{t}", column=pk, rule_type="pk_unique_active", kind="pk",
            keys=(pk,), active_only=True, message=REF_MSG["pk_unique_active"])
    for c, fk, p, pk in _FK:
        add(layer="source", table=c, column=fk, rule_type="fk", kind="fk", keys=(fk,), parent=p,
            parent_key=pk, message=REF_MSG["fk"].replace("{parent}", f"{p}.{pk}"))
    for c, fk, p, pk in _WH_FK:
        add(layer="warehouse", table=c, column=fk, rule_type="fk_active", kind="fk", keys=(fk,), parent=p,
            parent_key=pk, active_only=True, parent_active_only=True,
            message=REF_MSG["fk_active"].replace("{parent}", f"{p}.{pk}"))
    for t, cols in _NOT_NULL:
        for col in cols:
            add(layer="source", table=t, column=col, rule_type="not_null", kind="row",
                predicate=f"`{col}` IS NULL", columns_needed=(col,), message=REF_MSG["not_null"])
    for t, col, rtype, pred in _BUSINESS:
        for layer, name in (("source", t), ("warehouse", f"wh_{t}")):
            add(layer=layer, table=name, column=col, rule_type=rtype, kind="row", predicate=pred,
                columns_needed=_columns_in(pred), message=REF_MSG[rtype])
    for t, col, allowed in _ENUM:
        dom = ", ".join("'" + v + "'" for v in allowed)
        add(layer="source", table=t, column=col, rule_type="enum", kind="row",
            predicate=f"`{col}` NOT IN ({dom})", columns_needed=(col,),
            message=REF_MSG["enum"].replace("{allowed}", repr(allowed)))
    return rules


# --------------------------------------------------------------------------
# Evaluation
# --------------------------------------------------------------------------
def _message(rule: Rule, n: Column) -> Column:
    parts = rule.message.replace("{table}", rule.table).replace("{column}", rule.column or "").split("{n}")
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(n.cast("string"))
        if p:
            pieces.append(F.lit(p))
    return F.concat(*pieces)


def _result(rule: Rule, n: Column) -> list[Column]:
    return [F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.layer).alias("layer"),
            F.lit(rule.table).alias("table_name"), F.lit(rule.column).cast("string").alias("column_name"),
            F.lit(rule.rule_type).alias("rule_type"), n.cast("long").alias("violations"),
            F.when(n > 0, "fail").otherwise("pass").alias("status"),
            F.when(n > 0, _message(rule, n)).alias("message")]


def _missing(rule: Rule, tables: dict[str, DataFrame | None]) -> str | None:
    df = tables.get(rule.table)
    if df is None:
        return f"{rule.table}: dataset missing"
    need = set(rule.keys) | set(rule.columns_needed)
    if rule.active_only and DELETED not in df.columns:
        need.add(DELETED)
    gone = sorted(c for c in need if c not in df.columns)
    if gone:
        return f"{rule.table}: column(s) missing: {', '.join(gone)}"
    if rule.kind == "fk":
        p = tables.get(rule.parent)
        if p is None:
            return f"{rule.parent}: dataset missing"
        if rule.parent_key not in p.columns:
            return f"{rule.parent}: column(s) missing: {rule.parent_key}"
    return None


def _row_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All row rules of one dataset in one aggregate."""
    counts = []
    for i, r in enumerate(rules):
        broken = F.coalesce(F.expr(r.predicate), F.lit(False))
        if r.active_only and DELETED in df.columns:
            broken = broken & F.coalesce(~F.col(DELETED), F.lit(False))
        counts.append(F.count_if(broken).alias(f"c{i}"))
    rows = [F.struct(*_result(r, F.col(f"c{i}"))) for i, r in enumerate(rules)]
    return df.agg(*counts).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _key_text(cols: list[Column]) -> Column:
    """One text per key; NULL parts are kept apart from any value, and parts cannot run together."""
    parts = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
             for c in cols]
    return F.concat(*parts)


def _comparable(child: DataFrame, fk: str, parent: DataFrame, key: str) -> tuple[Column, Column]:
    """Both key columns in one type, so that equal keys have equal texts."""
    kinds = [child.schema[fk].dataType, parent.schema[key].dataType]
    columns = [F.col(fk), F.col(key)]
    same = kinds[0] == kinds[1] or all(isinstance(k, _INTEGRAL) for k in kinds)
    if not same and all(isinstance(k, T.NumericType) for k in kinds):
        columns = [c.cast("decimal(38,10)") for c in columns]
    return columns[0], columns[1]


def _keyed_rules(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """All primary and foreign key rules in one grouping (see the module's text)."""
    entries: dict[str, list[Column]] = {}

    def add(table: str, rule: int, key: Column, present: Column, active_only: bool, role: str) -> None:
        if active_only and DELETED in tables[table].columns:
            present = present & ~F.col(DELETED)
        one = F.struct(F.lit(rule).alias("rule"), key.alias("key"), F.lit(int(role == "child")).cast("long").alias("child"),
                       F.lit(int(role == "parent")).cast("long").alias("parent"))
        entries.setdefault(table, []).append(F.when(present, one))

    for i, r in enumerate(rules):
        if r.kind == "pk":
            add(r.table, i, _key_text([F.col(k) for k in r.keys]), F.lit(True), r.active_only, "child")
        else:
            child, parent = _comparable(tables[r.table], r.keys[0], tables[r.parent], r.parent_key)
            add(r.table, i, _key_text([child]), F.col(r.keys[0]).isNotNull(), r.active_only, "child")
            add(r.parent, i, _key_text([parent]), F.col(r.parent_key).isNotNull(), r.parent_active_only, "parent")
    rows = None
    for table, found in entries.items():
        one = tables[table].select(F.explode(F.array_compact(F.array(*found))).alias("e")).select("e.*")
        rows = one if rows is None else rows.unionByName(one)
    per_key = rows.groupBy("rule", "key").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))
    counts = []
    for i, r in enumerate(rules):
        mine = F.col("rule") == i
        counts.append(F.count_if(mine & (F.col("child") > 1)) if r.kind == "pk" else F.coalesce(
            F.sum(F.when(mine & (F.col("parent") == 0), F.col("child"))), F.lit(0)))
    found = per_key.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)])
    results = [F.struct(*_result(r, F.col(f"c{i}"))) for i, r in enumerate(rules)]
    return found.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def evaluate(spark: SparkSession, rules: list[Rule], tables: dict[str, DataFrame | None],
             strict: bool = False) -> DataFrame:
    """Run a rule suite; one result row per rule (lazy DataFrame)."""
    parts: list[DataFrame] = []
    skipped, keyed = [], []
    row_groups: dict[str, list[Rule]] = {}
    for r in rules:
        why = _missing(r, tables)
        if why is not None:
            skipped.append((r.rule_id, r.layer, r.table, r.column, r.rule_type, None,
                            "fail" if strict else "not_evaluated", why))
            continue
        if r.kind == "row":
            row_groups.setdefault(r.table, []).append(r)
        else:
            keyed.append(r)
    if keyed:
        parts.append(_keyed_rules(tables, keyed))
    for table, group in row_groups.items():
        parts.append(_row_rules(tables[table], group))
    out = spark.createDataFrame(skipped, RESULT_SCHEMA)
    for p in parts:
        out = out.unionByName(p)
    return out


def violations(result: DataFrame) -> list[str]:
    """Messages of failing rules (the reference's list-of-strings form)."""
    rows = result.where(F.col("status") == "fail").select("rule_id", "message").collect()
    return [r["message"] for r in sorted(rows, key=lambda r: r["rule_id"])]


# --------------------------------------------------------------------------
# L2-L5, L7
# --------------------------------------------------------------------------
def transition_violations(events: DataFrame, contract: Contract, column: str = "operation",
                          values: Column | None = None) -> DataFrame:
    """L2: per key, consecutive (previous, current) values of ``column``
    that the contract does not allow.  Uses the hot-key-safe previous-row
    scan.  Returns table_name, from_value, to_value, violations."""
    from tidemark.functions import scan
    v = values if values is not None else F.col(column)
    ev = events.where(F.col("table_name").isin(*contract.names)).select(
        "table_name", "primary_key", "sequence", v.alias("_v"))
    nb = scan.neighbours(ev, ["table_name", "primary_key"], ["sequence"], ["_v"], prev="_pv", nxt=None)
    allowed = []
    for t in contract.tables:
        for frm, to in t.transitions.get(column, ()):
            allowed.append((t.name, frm, to))
    spark = events.sparkSession
    ok = spark.createDataFrame(allowed, "table_name string, from_value string, to_value string")
    pairs = nb.select("table_name", F.col("_pv").getField("_v").alias("from_value"), F.col("_v").alias("to_value"))
    counted = pairs.groupBy("table_name", "from_value", "to_value").agg(F.count(F.lit(1)).alias("violations"))
    # The allowed-pair list comes from the contract: bounded, broadcast is safe.
    cond = ((counted.table_name == ok.table_name) & counted.from_value.eqNullSafe(ok.from_value)
            & (counted.to_value == ok.to_value))
    return counted.join(F.broadcast(ok), cond, "left_anti")


def totals_mismatch(parent: DataFrame, parent_key: str, parent_total: Column,
                    child: DataFrame, child_key: str, child_amount: Column, tolerance: str = "1.00") -> DataFrame:
    """L3: header total vs the sum of its lines (exact decimals).  One row:
    parents, parents_with_lines, mismatched, without_lines."""
    sums = child.groupBy(F.col(child_key).alias("_k")).agg(F.sum(child_amount).alias("_lines"))
    j = parent.select(F.col(parent_key).alias("_k"), parent_total.alias("_total")).join(sums, "_k", "left")
    off = F.abs(F.col("_total") - F.col("_lines")) > F.lit(tolerance).cast("decimal(18,2)")
    return j.agg(F.count(F.lit(1)).alias("parents"),
                 F.count_if(F.col("_lines").isNotNull()).alias("parents_with_lines"),
                 F.count_if(F.col("_lines").isNotNull() & off).alias("mismatched"),
                 F.count_if(F.col("_lines").isNull()).alias("without_lines"))


def running_balance(entries: DataFrame, key: str, order: str | list[str], amount: Column,
                    recorded: Column | None = None) -> DataFrame:
    """Per key the number of entries, the final and the lowest running
    balance, the entries at which it was below zero and, with ``recorded`` (the
    balance stored on each entry), the entries where it differs.  ``order``: columns
    of any orderable type, such as a time and, for entries of one time, an id."""
    from tidemark.functions import scan
    order = [order] if isinstance(order, str) else order
    names = [f"_o{i}" for i in range(len(order))]
    rows = entries.select(F.col(key).alias("_k"), *[F.col(c).alias(n) for c, n in zip(order, names)], amount.alias("_a"),
                          (recorded if recorded is not None else F.lit(None).cast("decimal(18,2)")).alias("_r"))
    run = scan.running_sum(rows, ["_k"], names, F.col("_a"), "_balance")
    return run.groupBy(F.col("_k").alias(key)).agg(
        F.count(F.lit(1)).alias("entries"),
        F.max_by("_balance", F.struct(*names)).cast("decimal(18,2)").alias("final_balance"),
        F.min("_balance").cast("decimal(18,2)").alias("lowest_balance"),
        F.count_if(F.col("_balance") < 0).alias("below_zero"),
        F.count_if(F.col("_r").isNotNull() & (F.col("_r") != F.col("_balance"))).alias("differs"))


def freshness(events: DataFrame, now: Column | None = None) -> DataFrame:
    """L4: per table, newest capture time and its lag (seconds) behind ``now``
    (default: the newest capture time of the whole feed)."""
    per = events.groupBy("table_name").agg(F.count(F.lit(1)).alias("events"),
                                           F.max("captured_at").alias("max_captured_at"))
    ref = now if now is not None else events.select(F.max("captured_at")).scalar()
    lag = F.floor((F.unix_micros(F.lit(ref).cast("timestamp")) -
                   F.unix_micros(F.col("max_captured_at").cast("timestamp"))) / 1_000_000).cast("long")
    return per.withColumn("lag_seconds", lag)


def completeness(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """L4: both-way key coverage between a source and its copy, in one grouping
    of both sides' keys (partial aggregation collapses repeated keys)."""
    both = source.select(*keys, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        target.select(*keys, F.lit(0).alias("_s"), F.lit(1).alias("_t")))
    per = both.groupBy(*keys).agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t"))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return per.agg(F.coalesce(F.sum("_s"), F.lit(0)).alias("source_rows"),
                   F.coalesce(F.sum("_t"), F.lit(0)).alias("target_rows"),
                   # a NULL key equals nothing: it is missing on the other side
                   F.count_if((F.col("_s") > 0) & ((F.col("_t") == 0) | ~known)).alias("missing_in_target"),
                   F.count_if((F.col("_t") > 0) & ((F.col("_s") == 0) | ~known)).alias("extra_in_target"))


def consistency(warehouse: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """Warehouse must equal the fold of the lake, row for row (as multisets),
    in one grouping of both sides' rows."""
    cols = warehouse.columns
    both = warehouse.select(*cols, F.lit(1).alias("_w"), F.lit(0).alias("_r")).unionByName(
        rebuilt.select(*cols, F.lit(0).alias("_w"), F.lit(1).alias("_r")))
    per = both.groupBy(*cols).agg(F.sum("_w").alias("_w"), F.sum("_r").alias("_r"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per.agg(total(F.col("_w")).alias("warehouse_rows"), total(F.col("_r")).alias("rebuild_rows"),
                   total(F.greatest(F.col("_w") - F.col("_r"), F.lit(0))).alias("only_in_warehouse"),
                   total(F.greatest(F.col("_r") - F.col("_w"), F.lit(0))).alias("only_in_rebuild"))


def differing_rows(left: DataFrame, right: DataFrame, keys: list[str], parts: int = 4096) -> DataFrame:
    """L5 with little data moved: rows that only one of two tables of equal columns has.

    Keys are dealt into ``parts`` ranges of their hash.  Each side reduces a range to
    its row count and two order-independent sums of row hashes (map-side, so ``parts``
    rows a task are shuffled), and only rows of ranges whose sums differ are compared.
    Columns: those of the tables, ``side`` ('left' or 'right') and ``copies``: how many
    more times the row stands on that side."""
    cols = left.columns
    part = F.pmod(F.xxhash64(*keys), F.lit(parts))

    def sums(df: DataFrame, sign: int) -> DataFrame:
        row = F.xxhash64(*cols)
        return df.groupBy(part.alias("_part")).agg(
            (F.count(F.lit(1)) * sign).alias("_n"), (F.sum(row.cast("decimal(20,0)")) * sign).alias("_s"),
            (F.sum(F.xxhash64(row, F.lit(1)).cast("decimal(20,0)")) * sign).alias("_t"))

    both = sums(left, 1).unionByName(sums(right.select(cols), -1)).groupBy("_part").agg(
        *[F.sum(c).alias(c) for c in ("_n", "_s", "_t")])
    # at most ``parts`` numbers
    unequal = F.broadcast(both.where("_n <> 0 or _s <> 0 or _t <> 0").select("_part"))
    pick = lambda df, n: df.select(*cols, part.alias("_part")).join(unequal, "_part", "left_semi").select(
        *cols, F.lit(n).cast("long").alias("_n"))
    per = pick(left, 1).unionByName(pick(right, -1)).groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return per.select(*cols, F.when(F.col("_n") > 0, "left").otherwise("right").alias("side"), F.abs("_n").alias("copies"))


def quarantine(df: DataFrame, table: TableContract, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every row with ``_reasons`` (array of failed rule ids, empty =
    good).  Row rules come from the contract (NOT NULL, domains, checks);
    foreign keys are looked up against distinct parent keys."""
    reasons = []
    for c in table.columns:
        if not c.nullable:
            reasons.append(F.when(F.col(c.name).isNull(), F.lit(f"not_null:{c.name}")))
        if c.domain:
            reasons.append(F.when(~F.col(c.name).isin(*c.domain), F.lit(f"enum:{c.name}")))
    for ck in table.checks:
        reasons.append(F.when(F.expr(ck.violation), F.lit(f"{ck.rule_type}:{ck.rule_id}")))
    out = df
    for fk in table.fks:
        p = (parents or {}).get(fk.parent)
        if p is None:
            continue
        flag = f"_has_{fk.column}"
        keys = p.select(F.col(fk.parent_column).alias("_parent")).distinct().withColumn(flag, F.lit(True))
        out = left_spread(out, keys, fk.column, "_parent").drop("_parent")
        reasons.append(F.when(F.col(fk.column).isNotNull() & F.col(flag).isNull(), F.lit(f"fk:{fk.column}")))
    arr = F.filter(F.array(*reasons), lambda x: x.isNotNull()) if reasons else F.array().cast("array<string>")
    cols = [c for c in out.columns if not c.startswith("_has_")]
    return out.select(*cols, arr.alias("_reasons"))


def split(df_with_reasons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with reasons)."""
    good = df_with_reasons.where(F.size("_reasons") == 0).drop("_reasons")
    bad = df_with_reasons.where(F.size("_reasons") > 0)
    return good, bad
