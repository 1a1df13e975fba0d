"""Append-only change lake (Parquet, partitioned by ingest batch and ``table_name``).

Stored row = the six lake columns + ``_ingest_batch`` (which append wrote it)
+ ``_restore_no`` (0 for source events, >0 for compensating restore events).

Append semantics:
* empty input -> 0 rows, nothing written;
* door checks first: no NULL in the six columns, operation in the domain;
* dedup inside the batch by sequence, deterministic winner (earliest
  ``captured_at``, then smallest content hash);
* dedup against the lake by sequence: first writer wins, later copies are
  dropped (and counted as conflicts when their content differs);
* the anti join opens only the folders of batches whose sequence range meets the
  batch's: ranges are part of the marker names, so one listing of names chooses
  the folders and no other folder is listed or opened; inside them Parquet
  min/max statistics prune (files are written sorted by sequence);
* unknown tables are kept; rows are never changed or removed.

Layout::

    <lake>/_ingest_batch=<b>/table_name=<t>/   rows of batch b
    <lake>/_commits/<b>.open                   id taken, before the first row
    <lake>/_commits/<b>.<lo>.<hi>.json         append ended: sequence range and counts
    <lake>/_commits/<b>.dead                   taken over by another run before it ended
    <lake>/_leases/<b>                         renewed while the append runs
    <lake>/_compacted/<n>/table_name=<t>/      rows of several batches, by sequence
    <lake>/_compactions/<n>.<first>.<last>.<lo>.<hi>.json   which batches those are

Every batch is written to a folder of its own, so appends that run at the same
time do not share Spark's temporary folder.  A batch whose append neither ended
nor still renews its lease is *dead*: its rows are taken over.  If its writer was
only slow, it finds itself declared dead when it ends and commits its rows under
a new id, so they are applied again and nothing is lost.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import INGEST_BATCH, LAKE_COLUMNS, LAKE_SCHEMA, OPERATIONS, RESTORE_NO
from tidemark.sources import fs

STORED_SCHEMA = T.StructType(
    LAKE_SCHEMA.fields
    + [T.StructField(INGEST_BATCH, T.LongType(), False), T.StructField(RESTORE_NO, T.IntegerType(), False)]
)
STORED_COLUMNS = [f.name for f in STORED_SCHEMA.fields]
COMMITS, LEASES, COMPACTED, COMPACTIONS = "_commits", "_leases", "_compacted", "_compactions"
# Seconds without renewal after which a running append counts as dead.
LEASE_SECONDS = 600

# Fixed value: the rejection message for an operation code outside the domain.
INVALID_OPERATION = "Invalid CDC operation {what}. Must be one of: {allowed}"


class InvalidOperationError(ValueError):
    pass


class LakeDoorError(ValueError):
    pass


@dataclass
class AppendResult:
    batch_id: int
    received: int
    written: int
    duplicates_in_batch: int
    already_in_lake: int
    conflicts: int
    tables: dict = None  # table -> (rows, min seq, max seq) written


def content_hash(df: DataFrame) -> F.Column:
    return F.xxhash64("table_name", "primary_key", "operation", "data")


@dataclass(frozen=True)
class Segment:
    """Rows of the batches ``first`` .. ``last`` in one folder; ``lo`` is None while the range is unknown."""
    first: int
    last: int
    lo: int | None
    hi: int | None
    folder: str
    compacted: bool = False


@dataclass(frozen=True)
class Log:
    """What one listing of marker names says about a lake."""
    open: frozenset           # ids taken whose append has not ended
    committed: dict           # id -> (lo, hi) or None if it wrote nothing
    rows_of: dict             # id -> id of the folder that holds its rows
    dead: frozenset
    compactions: tuple        # (n, first, last, lo, hi), newest of nested ones only

    @property
    def started(self) -> list[int]:
        ids = set(self.open) | set(self.committed)
        for _, first, last, _, _ in self.compactions:
            ids.update(range(first, last + 1))
        return sorted(ids)

    def covered(self, batch: int) -> bool:
        return any(first <= batch <= last for _, first, last, _, _ in self.compactions)


def read_log(spark: SparkSession, path: str) -> Log:
    open_, committed, rows_of, dead = set(), {}, {}, set()
    for name in fs.list_names(spark, f"{path}/{COMMITS}"):
        if name.startswith("."):
            continue
        parts = name.split(".")
        batch = int(parts[0])
        if parts[-1] == "open":
            open_.add(batch)
        elif parts[-1] == "dead":
            dead.add(batch)
        elif parts[-1] == "json":
            committed[batch] = None if parts[1] == "none" else (int(parts[1]), int(parts[2]))
            if parts[-2].startswith("of"):
                rows_of[batch] = int(parts[-2][2:])
    found = []
    for name in fs.list_names(spark, f"{path}/{COMPACTIONS}"):
        if name.endswith(".json") and not name.startswith("."):
            found.append(tuple(int(x) for x in name.split(".")[:5]))
    newest = [c for c in found if not any(d[0] > c[0] and d[1] <= c[1] and c[2] <= d[2] for d in found)]
    return Log(frozenset(open_ - set(committed)), committed, rows_of, frozenset(dead), tuple(sorted(newest, key=lambda c: c[1])))


def segments(spark: SparkSession, path: str, log: Log | None = None) -> list[Segment]:
    """The folders that make up the lake now.  A batch that a compaction took in is read there."""
    log = log or read_log(spark, path)
    out = [Segment(first, last, lo, hi, f"{path}/{COMPACTED}/{n}", True) for n, first, last, lo, hi in log.compactions]
    for batch in sorted(set(log.open) | set(log.committed)):
        span = log.committed.get(batch)
        if log.covered(batch) or batch in log.rows_of or (batch in log.committed and span is None):
            continue
        # rows that were committed under another id have that id's range
        span = span or next((log.committed[b] for b, of in log.rows_of.items() if of == batch), None)
        folder = f"{path}/{INGEST_BATCH}={batch}"
        if span or fs.exists(spark, folder):
            out.append(Segment(batch, batch, *(span or (None, None)), folder))
    return out


def read_segments(spark: SparkSession, path: str, chosen: list[Segment]) -> DataFrame:
    out = None
    plain = [s.folder for s in chosen if not s.compacted]
    if plain:
        out = spark.read.schema(STORED_SCHEMA).option("basePath", path).parquet(*plain).select(*STORED_COLUMNS)
    for s in chosen:
        if s.compacted:
            one = spark.read.schema(STORED_SCHEMA).parquet(s.folder).select(*STORED_COLUMNS)
            out = one if out is None else out.unionByName(one)
    return spark.createDataFrame([], STORED_SCHEMA) if out is None else out


def read_lake(spark: SparkSession, path: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """The lake as a DataFrame (empty, typed, if nothing was written yet).  With
    ``lo`` and ``hi`` only folders that can hold such sequences are opened."""
    chosen = segments(spark, path)
    if lo is None and hi is None:
        return read_segments(spark, path, chosen)
    inside = [s for s in chosen if s.lo is None or ((hi is None or s.lo <= hi) and (lo is None or s.hi >= lo))]
    rows = read_segments(spark, path, inside)
    if lo is not None:
        rows = rows.where(F.col("sequence") >= lo)
    return rows if hi is None else rows.where(F.col("sequence") <= hi)


def read_batches(spark: SparkSession, path: str, batches: list[int], log: Log | None = None) -> DataFrame:
    """Rows of some batches, from their folders alone."""
    log = log or read_log(spark, path)
    wanted = {log.rows_of.get(b, b) for b in batches}
    chosen = [s for s in segments(spark, path, log) if any(s.first <= b <= s.last for b in wanted)]
    rows = read_segments(spark, path, chosen)
    if any(s.compacted for s in chosen):
        rows = rows.where(F.col(INGEST_BATCH).isin(sorted(wanted)))
    return rows


def upto(lake: DataFrame, target: int | F.Column) -> DataFrame:
    """Events with ``sequence <= target`` (pushed into the Parquet scan)."""
    return lake.where(F.col("sequence") <= target)


def since(feed: DataFrame, offset: int | F.Column = 0) -> DataFrame:
    """A4: events with ``sequence > offset`` (strict)."""
    return feed.where(F.col("sequence") > offset)


def latest_sequence(feed: DataFrame) -> DataFrame:
    """A5: one row, highest sequence so far (0 when empty)."""
    return feed.agg(F.coalesce(F.max("sequence"), F.lit(0).cast("long")).alias("latest_sequence"))


def operation_check(feed: DataFrame) -> DataFrame:
    """B3 as a report: events per operation code and whether the code is valid."""
    return (feed.groupBy("operation").agg(F.count(F.lit(1)).alias("events"))
            .withColumn("is_valid", F.col("operation").isin(*OPERATIONS)))


@dataclass
class DoorStats:
    """Result of the one pass over an incoming batch."""
    n: int
    lo: int | None
    hi: int | None
    bad_ops: int
    nulls: dict[str, int]
    tables: dict[str | None, tuple[int, int, int]]  # table -> (rows, min seq, max seq)
    extra: dict[str, int]  # sums of caller-supplied count aggregates (e.g. the payload gate)


OTHER_TABLES = "*"


def door_stats(batch: DataFrame, extra: list[F.Column] = (), prepare=None,
               known: list[str] | None = None) -> DoorStats:
    """One aggregate over the batch, grouped by table (few groups, partial
    aggregation; with ``known``, all other tables are one group, so what is
    collected does not grow with the names found in the data): size, sequence bounds, NULL lake columns, bad operation
    codes, plus any extra count aggregates the caller wants in the same scan
    (``prepare`` adds the columns those aggregates read)."""
    if prepare is not None:
        batch = prepare(batch)
    aggs = [F.count(F.lit(1)).alias("n"), F.min("sequence").alias("lo"), F.max("sequence").alias("hi"),
            F.count_if(~F.col("operation").isin(*OPERATIONS)).alias("bad_ops")]
    aggs += [F.count_if(batch[c].isNull()).alias(f"null_{c}") for c in LAKE_COLUMNS]
    name = F.col("table_name")
    if known is not None:
        name = F.when(name.isin(*known), name).otherwise(OTHER_TABLES)
    rows = batch.groupBy(name.alias("table_name")).agg(*aggs, *extra).collect()
    extra_names = [f for f in (rows[0].asDict().keys() if rows else []) if f not in
                   {"table_name", "n", "lo", "hi", "bad_ops"} and not f.startswith("null_")]
    los = [r["lo"] for r in rows if r["lo"] is not None]
    his = [r["hi"] for r in rows if r["hi"] is not None]
    return DoorStats(
        n=sum(r["n"] for r in rows), lo=min(los) if los else None, hi=max(his) if his else None,
        bad_ops=sum(r["bad_ops"] for r in rows),
        nulls={c: sum(r[f"null_{c}"] for r in rows) for c in LAKE_COLUMNS},
        tables={r["table_name"]: (r["n"], r["lo"], r["hi"]) for r in rows},
        extra={k: sum(r[k] or 0 for r in rows) for k in extra_names})


def require_clean_door(stats: DoorStats) -> None:
    if stats.bad_ops:
        raise InvalidOperationError(INVALID_OPERATION.format(
            what=f"in {stats.bad_ops} event(s)", allowed=sorted(OPERATIONS)))
    nulls = {c: n for c, n in stats.nulls.items() if n}
    if nulls:
        raise LakeDoorError(f"lake columns must not be NULL: {nulls}")


def dedup_batch(batch: DataFrame, restore: bool = False) -> DataFrame:
    """One row per sequence, deterministic winner (earliest capture time,
    then smallest content hash).  Restore rows share one sequence, so they
    are unique per (sequence, restore no, table, key).  An aggregation, not a
    window: partial aggregation collapses a heavily replayed event inside
    each map task, so its copies never pile up in one task."""
    keys = ["sequence", RESTORE_NO, "table_name", "primary_key"] if restore else ["sequence"]
    others = [c for c in batch.columns if c not in keys]
    winner = F.min_by(F.struct(*[F.col(c) for c in others]),
                      F.struct(F.col("captured_at"), content_hash(batch)))
    return batch.groupBy(*keys).agg(winner.alias("_w")).select(*keys, *[F.col(f"_w.{c}") for c in others])


def _stored_range(lake: DataFrame) -> DataFrame:
    """(sequence, content hash) of source rows already in a range of the lake.  Two
    writers that ran at the same time may both have stored an event: it counts once."""
    return (lake.where(F.col(RESTORE_NO) == 0)
            .groupBy("sequence").agg(F.min(content_hash(lake)).alias("_h_lake")))


def committed_batches(spark: SparkSession, path: str) -> list[int]:
    return sorted(read_log(spark, path).committed)


def started_batches(spark: SparkSession, path: str) -> list[int]:
    """Every batch id ever taken: its rows may be in the lake, whether or not
    the append lived to write its commit marker."""
    return read_log(spark, path).started


class Lease:
    """Says that a batch's append is alive: a file that a thread renews until ``release``."""

    def __init__(self, spark: SparkSession, path: str, batch_id: int):
        self.spark, self.file = spark, f"{path}/{LEASES}/{batch_id}"
        self.ended = threading.Event()
        fs.touch(spark, self.file)
        self.thread = threading.Thread(target=self._renew, daemon=True)
        self.thread.start()

    def _renew(self) -> None:
        while not self.ended.wait(LEASE_SECONDS / 4):
            try:
                fs.touch(self.spark, self.file)
            except Exception:       # the next turn tries again; a lease that ends is found out at the commit
                continue

    def release(self) -> None:
        self.ended.set()
        self.thread.join()
        fs.remove(self.spark, self.file)


def alive(spark: SparkSession, path: str, batch_id: int) -> bool:
    """Whether the batch's append renewed its lease lately, by the store's clock."""
    last = fs.modified(spark, f"{path}/{LEASES}/{batch_id}")
    return last is not None and fs.store_time(spark, f"{path}/{LEASES}") - last < LEASE_SECONDS * 1000


def settled_batches(spark: SparkSession, path: str) -> list[int]:
    """Batches whose append ended or died: their rows will not change any more."""
    log = read_log(spark, path)
    return [b for b in log.started if b not in log.open or b in log.dead or not alive(spark, path, b)]


def declare_dead(spark: SparkSession, path: str, batch_id: int) -> None:
    """Take over a batch that did not end; its writer, if it lives, will see it."""
    try:
        fs.write_json_atomic(spark, f"{path}/{COMMITS}/{batch_id:020d}.dead", {"batch_id": batch_id})
    except FileExistsError:
        pass


def reserve_batch(spark: SparkSession, path: str, batch_id: int | None = None) -> tuple[int, Lease]:
    """Take a batch id, with its lease, before any row is written.  An id is taken
    once, so rows of a crashed append never share their id with another batch."""
    taken = started_batches(spark, path)
    if batch_id is None or batch_id in taken:
        batch_id = (taken[-1] + 1) if taken else 1
    while True:
        lease = Lease(spark, path, batch_id)        # before the id is seen as taken
        try:
            fs.write_json_atomic(spark, f"{path}/{COMMITS}/{batch_id:020d}.open", {"batch_id": batch_id})
            return batch_id, lease
        except FileExistsError:
            # another append was faster; its own thread goes on renewing the file
            lease.ended.set()
            batch_id += 1


def lake_max(spark: SparkSession, path: str) -> int:
    """A5 for a stored lake: highest sequence stored so far (0 if none), from marker
    names and the rows of batches that have no commit marker."""
    found = segments(spark, path)
    top = max([s.hi for s in found if s.hi is not None], default=0)
    unknown = [s for s in found if s.hi is None]
    if unknown:
        top = max(top, read_segments(spark, path, unknown).agg(F.max("sequence")).first()[0] or 0)
    return top


def is_late(mark: int) -> F.Column:
    """Rows that sort before something applied up to ``mark``: compensating rows
    share the sequence they were cut at and come after it."""
    return (F.col("sequence") < mark) | ((F.col("sequence") == mark) & (F.col(RESTORE_NO) == 0))


def write_rows(rows: DataFrame, path: str, tables: list[str] = (),
               marks: dict[str, int] | None = None) -> tuple[int, dict]:
    """Write a batch's rows to its folder, files sorted by sequence.  Returns rows
    written and, per table in ``tables``, (rows, min seq, max seq, late)
    written, all observed during the write itself (no extra pass).  ``late``
    counts rows that ``is_late`` for the table's high-water mark in ``marks``."""
    obs = Observation("lake_write")
    marks = marks or {}
    metrics = [F.count(F.lit(1)).alias("rows")]
    for i, t in enumerate(tables):
        mine = F.col("table_name") == t
        metrics += [F.count_if(mine).alias(f"n{i}"), F.min(F.when(mine, F.col("sequence"))).alias(f"lo{i}"),
                    F.max(F.when(mine, F.col("sequence"))).alias(f"hi{i}"),
                    F.count_if(mine & is_late(marks.get(t, 0))).alias(f"late{i}")]
    out = rows.select(*STORED_COLUMNS).observe(obs, *metrics).drop(INGEST_BATCH)
    # No repartition by table: one hot table would become one task.  Each
    # task writes its rows per table, sorted by sequence (tight min/max).
    (out.sortWithinPartitions("table_name", "sequence")
        .write.mode("append").partitionBy("table_name").parquet(path))
    got = obs.get
    per = {t: (int(got[f"n{i}"]), got[f"lo{i}"], got[f"hi{i}"], int(got[f"late{i}"]))
           for i, t in enumerate(tables) if got[f"n{i}"]}
    return int(got["rows"]), per


def append(spark: SparkSession, path: str, feed: DataFrame, batch_id: int | None = None,
           restore_no: int = 0, stats: DoorStats | None = None,
           marks: dict[str, int] | None = None, info: dict | None = None) -> AppendResult:
    """Idempotent append of change events; returns what was written.

    Idempotence rests on the sequence dedup alone: every attempt gets a batch
    id of its own and never skips.  ``info`` (such as stream and epoch) goes
    into the commit marker for readers, not for decisions.

    Jobs: the door pass (skipped when ``stats`` is given) and one write job
    (dedup window, left join with the lake's sequence range, filter, write),
    whose counts come from observations on the way."""
    batch = feed.select(*LAKE_COLUMNS)
    stats = stats or door_stats(batch)
    if not stats.n:
        return AppendResult(0, 0, 0, 0, 0, 0)
    require_clean_door(stats)
    batch_id, lease = reserve_batch(spark, path, batch_id)
    try:
        batch = (batch.withColumn(INGEST_BATCH, F.lit(batch_id).cast("long"))
                 .withColumn(RESTORE_NO, F.lit(restore_no).cast("int")))
        unique = dedup_batch(batch, restore=bool(restore_no))
        seen = Observation("lake_dedup")
        if restore_no:
            fresh = unique.observe(seen, F.count(F.lit(1)).alias("unique"), F.lit(0).alias("already"),
                                   F.lit(0).alias("conflicts"))
        else:
            j = unique.withColumn("_h", content_hash(unique)).join(
                _stored_range(read_lake(spark, path, stats.lo, stats.hi)), "sequence", "left")
            fresh = (j.observe(seen, F.count(F.lit(1)).alias("unique"),
                               F.count_if(F.col("_h_lake").isNotNull()).alias("already"),
                               F.count_if(F.col("_h_lake").isNotNull() & (F.col("_h") != F.col("_h_lake")))
                               .alias("conflicts"))
                     .where(F.col("_h_lake").isNull()))
        written, per_table = write_rows(fresh, f"{path}/{INGEST_BATCH}={batch_id}",
                                        [t for t in stats.tables if t not in (None, OTHER_TABLES)], marks)
        s = seen.get
        res = AppendResult(batch_id, stats.n, written, stats.n - int(s["unique"]), int(s["already"]),
                           int(s["conflicts"]), per_table)
        _commit(spark, path, res, stats, {"restore_no": restore_no, "info": info or {}})
    finally:
        lease.release()
    return res


def _commit(spark: SparkSession, path: str, res: AppendResult, stats: DoorStats, more: dict) -> None:
    """Mark the append as ended.  If another run took the batch over meanwhile, what
    it applied may lack rows: they are committed again under a new id."""
    span = f"{stats.lo}.{stats.hi}" if res.written else "none"
    body = {"written": res.written, "received": stats.n, "lo": stats.lo, "hi": stats.hi,
            "tables": {t: list(v) for t, v in (res.tables or {}).items()}, **more}
    held, lease = res.batch_id, None
    try:
        if fs.exists(spark, f"{path}/{COMMITS}/{held:020d}.dead"):
            res.batch_id, lease = reserve_batch(spark, path)
            span += f".of{held}"
        fs.write_json_atomic(spark, f"{path}/{COMMITS}/{res.batch_id:020d}.{span}.json", {"batch_id": res.batch_id, **body})
    finally:
        if lease is not None:
            lease.release()


def batch_rows(lake: DataFrame, batch_id: int) -> DataFrame:
    return lake.where(F.col(INGEST_BATCH) == batch_id)


def sequence_health(feed: DataFrame) -> DataFrame:
    """One row of sequence health: duplicates, conflicts, gaps."""
    per_seq = feed.groupBy("sequence").agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_distinct(content_hash(feed)).alias("versions"))
    return per_seq.agg(
        F.count(F.lit(1)).alias("distinct_sequences"),
        F.sum("copies").alias("events"),
        F.min("sequence").alias("min_sequence"),
        F.max("sequence").alias("max_sequence"),
        F.count_if(F.col("copies") > 1).alias("duplicate_sequences"),
        F.count_if(F.col("versions") > 1).alias("conflicting_sequences"),
    ).select(
        "events", "distinct_sequences", "min_sequence", "max_sequence",
        "duplicate_sequences", "conflicting_sequences",
        (F.col("max_sequence") - F.col("min_sequence") + 1 - F.col("distinct_sequences")).alias("missing_sequences"),
    )


def append_restore(spark: SparkSession, path: str, rows: DataFrame, restore_no: int) -> AppendResult:
    """Append compensating rows of one restore (deduplicated per key, never
    against source sequences, which they share on purpose)."""
    return append(spark, path, rows, restore_no=restore_no)


def compact(spark: SparkSession, path: str, least_batches: int = 2, rows_per_file: int = 1_000_000) -> int | None:
    """Rewrite the longest run of ended batches with neighbouring ids into files
    clustered by table and sequence.  Returns the compaction's number.

    Readers see the old folders until the marker exists and the new one from then
    on; each row keeps its batch id.  Old folders stay until ``vacuum``."""
    log = read_log(spark, path)
    ids, runs, run = set(log.started), [], []
    for b in range(min(ids, default=1), max(ids, default=0) + 1):
        # a batch without a commit may still get rows from a slow writer
        if b in ids and b not in log.open:
            run.append(b)
        else:
            runs, run = runs + [run], []
    run = max(runs + [run], key=len, default=[])
    if len(run) < least_batches or any(c[1] == run[0] and c[2] == run[-1] for c in log.compactions):
        return None
    chosen = [s for s in segments(spark, path, log) if run[0] <= s.first and s.last <= run[-1]]
    rows = read_segments(spark, path, chosen)
    stats = rows.agg(F.count("*"), F.min("sequence"), F.max("sequence")).first()
    taken = [int(n.split(".")[0]) for n in fs.list_names(spark, f"{path}/{COMPACTIONS}") if not n.startswith(".")]
    number = max(taken, default=0) + 1
    fs.write_json_atomic(spark, f"{path}/{COMPACTIONS}/{number}.open", {"batches": len(run)})
    files = max(1, -(-int(stats[0]) // rows_per_file))
    (rows.repartitionByRange(files, "table_name", "sequence", RESTORE_NO).sortWithinPartitions("table_name", "sequence")
         .write.mode("overwrite").partitionBy("table_name").parquet(f"{path}/{COMPACTED}/{number}"))
    fs.write_json_atomic(spark, f"{path}/{COMPACTIONS}/{number}.{run[0]}.{run[-1]}.{stats[1] or 0}.{stats[2] or 0}.json",
                         {"rows": int(stats[0]), "batches": len(run)})
    return number


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove folders and markers that a compaction has taken the place of.  Call it
    when no reader started before the compaction is still running."""
    log, removed = read_log(spark, path), 0
    for b in sorted(set(log.open) | set(log.committed)):
        if log.covered(b):
            fs.remove(spark, f"{path}/{INGEST_BATCH}={b}")
            removed += 1
    for name in fs.list_names(spark, f"{path}/{COMMITS}"):
        # which folder an adopted batch's rows are in stays known
        if not name.startswith(".") and ".of" not in name and log.covered(int(name.split(".")[0])):
            fs.remove(spark, f"{path}/{COMMITS}/{name}")
    live = {c[0] for c in log.compactions}
    for name in fs.list_names(spark, f"{path}/{COMPACTIONS}"):
        if name.endswith(".json") and not name.startswith(".") and int(name.split(".")[0]) not in live:
            fs.remove(spark, f"{path}/{COMPACTED}/{name.split('.')[0]}")
            fs.remove(spark, f"{path}/{COMPACTIONS}/{name}")
    return removed


def register_table(spark: SparkSession, path: str, name: str = "lake_cdc_events") -> str:
    """Idempotent catalog table over the lake folder, partitioned by batch and
    table; after a compaction a view over its folders and the batches since."""
    parts = (INGEST_BATCH, "table_name")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in STORED_SCHEMA.fields
                     if f.name not in parts)
    done = read_log(spark, path).compactions
    quoted = lambda n: ".".join(f"`{x}`" for x in n.split("."))
    table = quoted(f"{name}_batches" if done else name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}, `{INGEST_BATCH}` bigint, `table_name` string) "
              f"USING parquet PARTITIONED BY (`{INGEST_BATCH}`, `table_name`) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {table}")
    if done:
        columns = ", ".join(f"`{c}`" for c in STORED_COLUMNS)
        live = " AND ".join(f"`{INGEST_BATCH}` NOT BETWEEN {c[1]} AND {c[2]}" for c in done)
        both = [f"SELECT {columns} FROM {table} WHERE {live}"]
        both += [f"SELECT {columns} FROM parquet.`{path}/{COMPACTED}/{c[0]}`" for c in done]
        spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS {' UNION ALL '.join(both)}")
    return name
