"""Per-key ordered scans (row number, previous/next row, running last value,
running sum) that stay parallel when one key holds a large share of all rows.

A plain ``Window.partitionBy(key).orderBy(seq)`` sends every row of a key to
one task.  Here all rows are dealt once, by range of (key, order), into chunks of
about equal row counts: the cut points come from the distribution of the rows
themselves (Spark's range partitioner), so a hot key spans many chunks, whether
its order values are dense, sparse, numbers, times or several columns with ties.
The dealt rows are stored once, because cut points come from a sample and two
runs of one plan may cut differently; every branch reads that copy.

Windows then run per (key, chunk).  What a chunk needs from the chunks before and
after (a row-count offset, the neighbouring row, the last value seen, a sum)
comes from a summary with one row per key and chunk.  A key spans no more
chunks than there are, so the summary's window per key is small.  One scan can
answer several of these questions with one deal and one summary (``over``).

``order`` should make rows of a key distinct where the result depends on it; rows
that tie in it stay in one chunk, in no particular order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import new_work_dir

CHUNK = "_chunk"


def chunked(df: DataFrame, keys: list[str], order: list[str], chunks: int | None = None) -> DataFrame:
    """``df`` stored in about ``chunks`` (default: shuffle partitions) ranges of equal
    row counts by (keys, order), with the range's number."""
    spark = df.sparkSession
    n = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *keys, *order).withColumn(CHUNK, F.spark_partition_id().cast("long"))
    path = new_work_dir(spark, "chunks")
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def over(df: DataFrame, keys: list[str], order: list[str], *, number: str | None = None,
         prev: tuple[str, list[str]] | None = None, nxt: tuple[str, list[str]] | None = None,
         last: dict[str, tuple[Column, Column]] | None = None, total: dict[str, Column] | None = None,
         chunks: int | None = None) -> DataFrame:
    """``df`` with the columns asked for:

    * ``number``: 1-based position of the row within its key;
    * ``prev`` / ``nxt`` = (name, columns): struct of the neighbouring row, NULL at the ends;
    * ``last`` = {name: (value, present)}: value of the latest row so far, this one
      included, where ``present`` holds.  An explicit NULL that is present counts
      (it is carried in a one-field struct so ``ignorenulls`` does not skip it);
    * ``total`` = {name: amount}: sum over the rows up to this one (NULL adds nothing).
    """
    last, total = last or {}, total or {}
    boxes = [F.when(p, F.struct(v.alias("v"))).alias(f"_b_{n}") for n, (v, p) in last.items()]
    sums = [a.alias(f"_a_{n}") for n, a in total.items()]
    d = chunked(df.select("*", *boxes, *sums), keys, order, chunks)

    by = [F.col(c).asc() for c in order]
    w = Window.partitionBy(*keys, CHUNK).orderBy(*by)
    sofar = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = {what: F.struct(*[F.col(c) for c in cols]) for what, cols in
           (("p", prev[1] if prev else ()), ("n", nxt[1] if nxt else ())) if cols}
    local = d.select("*", *([F.row_number().over(w).alias("_rn")] if number else []),
                     *([F.lag(row["p"]).over(w).alias("_lp")] if prev else []),
                     *([F.lead(row["n"]).over(w).alias("_ln")] if nxt else []),
                     *[F.last(f"_b_{n}", ignorenulls=True).over(sofar).alias(f"_l_{n}") for n in last],
                     *[F.sum(f"_a_{n}").over(sofar).alias(f"_r_{n}") for n in total])

    at = F.struct(*[F.col(c) for c in order])
    summary = d.groupBy(*keys, CHUNK).agg(
        F.count(F.lit(1)).alias("_n"),
        *([F.max_by(row["p"], at).alias("_tail")] if prev else []),
        *([F.min_by(row["n"], at).alias("_head")] if nxt else []),
        *[F.max_by(F.col(f"_b_{n}"), F.when(F.col(f"_b_{n}").isNotNull(), at)).alias(f"_s_{n}") for n in last],
        *[F.sum(f"_a_{n}").alias(f"_t_{n}") for n in total])
    ws = Window.partitionBy(*keys).orderBy(CHUNK)
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col(CHUNK).alias("_c"),
        *([F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")] if number else []),
        *([F.lag("_tail").over(ws).alias("_cp")] if prev else []),
        *([F.lead("_head").over(ws).alias("_cn")] if nxt else []),
        *[F.last(f"_s_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in last],
        *[F.sum(f"_t_{n}").over(before).alias(f"_u_{n}") for n in total])
    same = F.col(CHUNK) == F.col("_c")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))

    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    found = {}
    if number:
        found[number] = (F.col("_off") + F.col("_rn")).cast("long")
    if prev:
        found[prev[0]] = F.coalesce("_lp", "_cp")
    if nxt:
        found[nxt[0]] = F.coalesce("_ln", "_cn")
    found |= {n: F.coalesce(f"_l_{n}", f"_c_{n}").getField("v") for n in last}
    found |= {n: zero(f"_u_{n}") + zero(f"_r_{n}") for n in total}
    kept = [F.col(c) for c in df.columns if c not in found]
    return local.join(summary, same).select(*kept, *[c.alias(n) for n, c in found.items()])


def row_number(df: DataFrame, keys: list[str], order: list[str], out: str = "version_no",
               chunks: int | None = None) -> DataFrame:
    return over(df, keys, order, number=out, chunks=chunks)


def neighbours(df: DataFrame, keys: list[str], order: list[str], cols: list[str],
               prev: str | None = "_prev", nxt: str | None = "_next", chunks: int | None = None) -> DataFrame:
    return over(df, keys, order, prev=(prev, cols) if prev else None, nxt=(nxt, cols) if nxt else None, chunks=chunks)


def running_last(df: DataFrame, keys: list[str], order: list[str],
                 values: dict[str, tuple[Column, Column]], chunks: int | None = None) -> DataFrame:
    return over(df, keys, order, last=values, chunks=chunks)


def running_sum(df: DataFrame, keys: list[str], order: list[str], amount: Column, out: str,
                chunks: int | None = None) -> DataFrame:
    return over(df, keys, order, total={out: amount}, chunks=chunks)
