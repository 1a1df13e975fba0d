"""DuckDB SQL that states, independently of the Spark code, what each
registered query must return on the driver's tables.  The SQL works on the
source tables directly (no JSON round trip), so it checks the library's
encoding, lake and fold end to end."""

from __future__ import annotations

# The events -> change feed binding (same rule as tidemark.sources.testdata).
FEED = """feed AS (
  SELECT event_id + 1 AS sequence,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS operation,
         CASE WHEN user_id % 2 = 0 THEN 'accounts' ELSE 'devices' END AS table_name,
         CAST(user_id AS VARCHAR) AS primary_key,
         ts AS captured_at,
         user_id, event_type,
         CAST(value AS DECIMAL(18,2)) AS value,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         event_id
  FROM events)"""

# Presence and value of each payload field, per feed variant.
FIELDS = {
    "image": {
        "event_type": ("operation <> 'delete'", "event_type"),
        "value": ("operation <> 'delete'", "value"),
        "k": ("operation <> 'delete'", "k"),
    },
    "patch": {
        "event_type": ("operation <> 'delete'", "event_type"),
        "value": ("operation <> 'delete' AND event_type <> 'view'", "value"),
        "k": ("operation <> 'delete'", "CASE WHEN event_type = 'click' THEN NULL ELSE k END"),
    },
}


def json_payload(variant: str = "image") -> str:
    """The JSON text the Spark side writes for a feed row (Spark's to_json layout)."""
    k = "k" if variant == "image" else "CASE WHEN event_type = 'click' THEN NULL ELSE k END"
    k_txt = f"coalesce(CAST({k} AS VARCHAR), 'null')"
    head = "'{\"user_id\":' || CAST(user_id AS VARCHAR) || ',\"event_type\":\"' || event_type || '\"'"
    val = "',\"value\":' || coalesce(CAST(value AS VARCHAR), 'null')"
    full = f"{head} || {val} || ',\"k\":' || {k_txt} || '}}'"
    if variant == "patch":
        no_val = f"{head} || ',\"k\":' || {k_txt} || '}}'"
        body = f"CASE WHEN event_type = 'view' THEN {no_val} ELSE {full} END"
    else:
        body = full
    return f"CASE WHEN operation = 'delete' THEN '{{}}' ELSE {body} END"


def fold_select(variant: str = "patch", source: str = "feed", keep_deleted: bool = True) -> str:
    """Per-key fold of ``source`` (feed-shaped rows) into warehouse rows."""
    cols = []
    for name, (present, value) in FIELDS[variant].items():
        cols.append(f"arg_max_null({value}, sequence) FILTER (WHERE {present}) AS {name}")
    where = "n_up > 0" if keep_deleted else "n_up > 0 AND NOT _deleted"
    return f"""SELECT table_name, user_id, event_type, value, k, _cdc_seq, _deleted FROM (
  SELECT table_name, CAST(primary_key AS BIGINT) AS user_id,
         {', '.join(cols)},
         max(sequence) AS _cdc_seq,
         arg_max(operation, sequence) = 'delete' AS _deleted,
         count(*) FILTER (WHERE operation <> 'delete') AS n_up
  FROM {source} GROUP BY table_name, primary_key) AS f WHERE {where}"""


def half_sequence(source: str = "feed") -> str:
    """Scalar: half of the highest sequence (integer)."""
    return f"(SELECT CAST(floor(max(sequence) / 2) AS BIGINT) FROM {source})"


def states_cte(variant: str = "patch", source: str = "feed") -> str:
    """Per event: row state right after it (running last present value)."""
    cols = []
    for name, (present, value) in FIELDS[variant].items():
        cols.append(f"(last_value(CASE WHEN {present} THEN {{'v': {value}}} END IGNORE NULLS) OVER w).v AS s_{name}")
    return f"""st AS (
  SELECT table_name, primary_key, user_id, sequence, operation, captured_at, {', '.join(cols)},
         lead(sequence) OVER w2 AS next_seq, lead(captured_at) OVER w2 AS next_ts
  FROM {source}
  WINDOW w AS (PARTITION BY table_name, primary_key ORDER BY sequence
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         w2 AS (PARTITION BY table_name, primary_key ORDER BY sequence))"""


def image_json(prefix: str = "") -> str:
    """Full image JSON (explicit nulls) of user_id, event_type, value, k."""
    p = prefix
    return ("'{\"user_id\":' || CAST(" + p + "user_id AS VARCHAR) || ',\"event_type\":' || "
            "coalesce('\"' || " + p + "event_type || '\"', 'null') || ',\"value\":' || "
            "coalesce(CAST(" + p + "value AS VARCHAR), 'null') || ',\"k\":' || "
            "coalesce(CAST(" + p + "k AS VARCHAR), 'null') || '}'")


# --- data-quality rules -------------------------------------------------------
RULE_COLS = "rule_id, layer, table_name, column_name, rule_type, violations, status"


def _rule_row(rule_id, layer, table, column, rule_type, count_sql) -> str:
    col = "NULL" if column is None else f"'{column}'"
    return (f"SELECT '{rule_id}' AS rule_id, '{layer}' AS layer, '{table}' AS table_name, "
            f"CAST({col} AS VARCHAR) AS column_name, '{rule_type}' AS rule_type, "
            f"CAST(n AS BIGINT) AS violations, CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END AS status "
            f"FROM ({count_sql}) AS c(n)")


def pk_sql(rule_id, table, keys, layer="source", rule_type="pk_unique", source=None, where="TRUE") -> str:
    k = ", ".join(keys)
    src = source or table
    return _rule_row(rule_id, layer, table, "+".join(keys), rule_type,
                     f"SELECT count(*) FROM (SELECT {k} FROM {src} WHERE {where} GROUP BY {k} HAVING count(*) > 1) d")


def fk_sql(rule_id, table, col, parent, parent_col, layer="source", rule_type="fk",
           child_src=None, parent_src=None) -> str:
    c, p = child_src or table, parent_src or parent
    return _rule_row(rule_id, layer, table, col, rule_type,
                     f"SELECT count(*) FROM {c} ch WHERE ch.{col} IS NOT NULL AND NOT EXISTS "
                     f"(SELECT 1 FROM {p} pa WHERE pa.{parent_col} = ch.{col})")


def row_sql(rule_id, table, column, rule_type, predicate, layer="source", source=None) -> str:
    return _rule_row(rule_id, layer, table, column, rule_type,
                     f"SELECT count(*) FILTER (WHERE {predicate}) FROM {source or table}")


def contract_rules_sql(contract, rule_types=None) -> str:
    """Every source-layer rule a contract implies, as UNION ALL of counts."""
    parts = []
    for t in contract.tables:
        def want(rt):
            return rule_types is None or rt in rule_types
        if want("pk_unique"):
            parts.append(pk_sql(f"{t.name}:pk_unique:{'+'.join(t.pk)}", t.name, t.pk))
        for fk in t.fks:
            if want("fk"):
                parts.append(fk_sql(f"{t.name}:fk:{fk.column}", t.name, fk.column, fk.parent, fk.parent_column))
        for c in t.columns:
            if not c.nullable and c.name not in t.pk and want("not_null"):
                parts.append(row_sql(f"{t.name}:not_null:{c.name}", t.name, c.name, "not_null", f"{c.name} IS NULL"))
            if c.domain and want("enum"):
                dom = ", ".join("'" + v + "'" for v in c.domain)
                parts.append(row_sql(f"{t.name}:enum:{c.name}", t.name, c.name, "enum", f"{c.name} NOT IN ({dom})"))
        for ck in t.checks:
            if want(ck.rule_type):
                parts.append(row_sql(f"{t.name}:{ck.rule_type}:{ck.rule_id}", t.name, ck.column, ck.rule_type,
                                     ck.violation))
    return "\nUNION ALL\n".join(parts)
