"""Joins that stay spread when many rows have no key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def left_spread(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join on one key.  Rows without a key match nothing, yet a plain outer join
    sends all of them to one task; here they carry a number made of their content
    in a second key column and spread over the tasks."""
    plain = [f.name for f in left.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    kind = right.schema[right_key].dataType
    # not a constant: the optimizer would take that out of the join's keys
    own = F.when(F.col(left_key).isNull(), F.xxhash64(*[F.col(f"`{c}`") for c in plain]))
    rows = left.select("*", F.coalesce(own, F.xxhash64(F.col(left_key).try_cast(kind))).alias("_spread"))
    other = right.select("*", F.xxhash64(right_key).alias("_spread_r"))
    return rows.join(other, (rows[left_key] == other[right_key]) & (rows["_spread"] == other["_spread_r"]), "left").drop(
        "_spread", "_spread_r")
