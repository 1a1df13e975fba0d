"""Payload encoding and decoding (JSON text inside lake rows).

Two parses of the same text are needed: a typed parse with the contract's
StructType gives exact values (decimals stay exact), and the key list tells
an absent key apart from an explicit JSON null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import TableContract

# Keep explicit NULL fields in the JSON text: absent and null mean different things.
JSON_OPTIONS = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def encode(*cols: Column | str) -> Column:
    """JSON object text of the given columns; NULL values are written as null."""
    return F.to_json(F.struct(*cols), JSON_OPTIONS)


def parse_schema(table: TableContract) -> T.StructType:
    """Parse schema for payloads.  Timestamps are read as zoned TIMESTAMP (so
    offsets like +05:30 are honoured) and turned into UTC wall-clock NTZ later."""
    fields = []
    for c in table.columns:
        dtype = T.TimestampType() if isinstance(c.dtype, T.TimestampNTZType) else c.dtype
        fields.append(T.StructField(c.name, dtype, True))
    return T.StructType(fields)


def typed(data: Column | str, table: TableContract) -> Column:
    """Struct of typed payload values (NULL for absent, null or unparsable)."""
    return F.from_json(data, parse_schema(table), {"mode": "PERMISSIVE"})


def value_of(parsed: Column, table: TableContract, name: str) -> Column:
    """One typed field out of ``typed(...)``, cast to its contract type."""
    v = parsed.getField(name)
    if isinstance(table.column(name).dtype, T.TimestampNTZType):
        v = v.cast(T.TimestampNTZType())
    return v


def keys(data: Column | str) -> Column:
    """Array of top-level keys of the JSON object (NULL if malformed)."""
    return F.json_object_keys(data)


def has_key(key_array: Column, name: str) -> Column:
    return F.coalesce(F.array_contains(key_array, name), F.lit(False))


NUMBER_TEXT = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


def bad_value(parsed_field: Column, key_array: Column, raw: Column, dtype: T.DataType, name: str) -> Column:
    """Value present and not null in the JSON, but unusable as ``dtype``:
    the typed parse gave NULL, or a numeric field was not plain number
    text (Spark's JSON reader would read "12,5" as 125 for a decimal)."""
    present = has_key(key_array, name) & raw.isNotNull()
    bad = parsed_field.isNull()
    if isinstance(dtype, T.NumericType):
        bad = bad | ~raw.rlike(NUMBER_TEXT)
    return present & bad
