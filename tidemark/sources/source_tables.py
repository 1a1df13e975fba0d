"""Source tables read against their contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import Contract, TableContract


def conform(df: DataFrame, table: TableContract) -> DataFrame:
    """Contract column order and types.  A column the source does not send
    gets its declared DEFAULT (e.g. 0.00 for a fee), or NULL; an explicit
    NULL in a present column stays NULL (the data checks report it)."""
    cols = []
    for c in table.columns:
        if c.name in df.columns:
            cols.append(F.col(c.name).cast(c.dtype).alias(c.name))
        else:
            default = F.lit(c.default) if c.default is not None else F.lit(None)
            cols.append(default.cast(c.dtype).alias(c.name))
    return df.select(*cols)


def read_source(spark: SparkSession, path: str, table: TableContract, fmt: str = "parquet") -> DataFrame:
    """A2: scan one source table with the contract schema (no inference)."""
    return conform(spark.read.format(fmt).load(path), table)


def read_sources(spark: SparkSession, root: str, contract: Contract, fmt: str = "parquet") -> dict[str, DataFrame]:
    """All contract tables below ``root/<table>``; a table that is not
    there maps to None (the schema gate reports it)."""
    from tidemark.sources import fs
    out = {}
    for t in contract.tables:
        p = f"{root.rstrip('/')}/{t.name}"
        out[t.name] = spark.read.format(fmt).load(p) if fs.exists(spark, p) else None
    return out
