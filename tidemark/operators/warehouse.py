"""Current-state warehouse tables kept as versioned Parquet: a base and changes.

Layout per table::

    <root>/wh_<table>/v=<n>-<id>/       complete snapshot of version n (a base)
    <root>/wh_<table>/d=<n>-<id>/       the rows that version n changed
    <root>/wh_<table>/_commits/<n>.json {version, hwm, batch, applied, base, deltas ...} written last

A version becomes visible only when its commit marker exists (create-only,
renamed into place), so a crash leaves at most an orphan directory.  A path
being read is never overwritten.  ``hwm`` is the highest lake sequence applied to
the table, ``applied`` the lake batches it holds (ranges of ids): what is applied
is known by that set, never by comparing ids, because a batch with a lower id may
end later.  Two runs that apply at once build on the same version; the second to
commit finds its number taken and merges anew.

A batch writes only the rows of the keys it touched.  A read takes the base
without the changed keys (an anti join, broadcast by AQE when its runtime size
allows) and the newest change of each.  When the changes have grown to the size
of the base (``FOLD_AT``), the next version is written as a new base, so a row is
rewritten a bounded number of times on average and reads touch at most about
twice the table.

Apply paths, one result (property-tested against the full rebuild):

* fast path: every event in the batch is newer than the table's ``hwm``.
  The prior row of each touched key is folded together with the new events;
* general path: some event is late, so the keys with a late event are folded from
  the newest version that lies wholly below it and the batches since (a tail
  of the lake); keys for which there is none are folded from their history.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import INGEST_BATCH, RESTORE_NO, Contract, TableContract
from tidemark.operators import fold as fold_mod
from tidemark.operators import lake as lake_mod
from tidemark.sources import fs


@dataclass
class ApplyReport:
    table: str
    path: str  # "fast", "general", "mixed", "skipped"
    version: int | None
    events: int
    late: int = 0  # J9: events at or below the table's applied high-water mark
    written: int = 0  # rows of the new version's folder


# Changed rows, as a share of the base, from which on a new base is written; and the
# most folders of changes that a read may have to open.
FOLD_AT, MOST_DELTAS = 1.0, 64
VERSION = "_version"


def ranges(ids) -> list[list[int]]:
    """Sorted ids as inclusive ranges."""
    out: list[list[int]] = []
    for i in sorted(set(ids)):
        if out and i <= out[-1][1] + 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return out


def merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def holds(meta: dict | None, batch: int) -> bool:
    return meta is not None and any(lo <= batch <= hi for lo, hi in meta["applied"])


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, contract: Contract, parallel_tables: int = 4):
        self.spark, self.root, self.contract = spark, root.rstrip("/"), contract
        self.parallel_tables = max(1, parallel_tables)

    # -- storage -----------------------------------------------------------
    def table_dir(self, table: TableContract) -> str:
        return f"{self.root}/{table.wh_name}"

    def commits(self, table: TableContract) -> list[dict]:
        d = f"{self.table_dir(table)}/_commits"
        out = []
        for name in fs.list_names(self.spark, d):
            if name.endswith(".json") and not name.startswith("."):
                out.append(fs.read_json(self.spark, f"{d}/{name}"))
        return sorted(out, key=lambda m: m["version"])

    def current_meta(self, table: TableContract) -> dict | None:
        """Newest commit marker (names are zero-padded: the max name wins)."""
        d = f"{self.table_dir(table)}/_commits"
        names = [n for n in fs.list_names(self.spark, d) if n.endswith(".json") and not n.startswith(".")]
        return fs.read_json(self.spark, f"{d}/{max(names)}") if names else None

    def meta(self, table: TableContract, version: int) -> dict | None:
        return fs.read_json(self.spark, f"{self.table_dir(table)}/_commits/{version:010d}.json")

    def read(self, table: TableContract | str, version: int | None = None) -> DataFrame:
        """K8: the snapshot at ``version`` (default: latest committed)."""
        if isinstance(table, str):
            table = self.contract.table(table)
        meta = self.current_meta(table) if version is None else self.meta(table, version)
        if meta is None and version is not None:
            raise KeyError(f"{table.wh_name} has no committed version {version}")
        return self._state(table, meta)

    def _state(self, table: TableContract, meta: dict | None) -> DataFrame:
        struct, pk = table.warehouse_struct, table.single_pk
        if meta is None:
            return self.spark.createDataFrame([], struct)
        base = self.spark.read.schema(struct).parquet(f"{self.table_dir(table)}/{meta['base']}")
        if not meta["deltas"]:
            return base
        changes = self.spark.read.schema(struct.add(VERSION, "long")).parquet(
            *[f"{self.table_dir(table)}/{d}" for d in meta["deltas"]])
        names = [n for n in struct.fieldNames() if n != VERSION]
        newest = (changes.groupBy(pk).agg(F.max_by(F.struct(*[n for n in names if n != pk]), F.col(VERSION)).alias("_n"))
                  .select(*[F.col(n) if n == pk else F.col(f"_n.{n}").alias(n) for n in names]))
        return base.join(changes.select(pk).distinct(), pk, "left_anti").select(*names).unionByName(newest)

    def _commit(self, table: TableContract, prior: dict | None, **body) -> dict:
        version = (prior["version"] if prior else 0) + 1
        meta = {"version": version, **body}
        fs.write_json_atomic(self.spark, f"{self.table_dir(table)}/_commits/{version:010d}.json", meta)
        return meta

    def publish(self, table: TableContract, snapshot: DataFrame, hwm: int, batch: int,
                applied: list[list[int]] | None = None, prior: dict | None = None) -> int:
        """Write a complete snapshot as the next version."""
        prior = prior or self.current_meta(table)
        version = (prior["version"] if prior else 0) + 1
        folder = f"v={version}-{uuid.uuid4().hex[:8]}"      # two runs may write this version at once
        seen = Observation("base")
        (snapshot.select(*table.warehouse_struct.fieldNames()).observe(seen, F.count(F.lit(1)).alias("n"))
            .write.mode("errorifexists").parquet(f"{self.table_dir(table)}/{folder}"))
        rows = int(seen.get["n"])
        self._commit(table, prior, hwm=int(hwm), batch=int(batch), applied=applied or [[int(batch), int(batch)]],
                     base=folder, deltas=[], base_rows=rows, delta_rows=0, written=rows)
        return version

    def publish_changes(self, table: TableContract, prior: dict, changed: DataFrame, hwm: int, batch: int,
                        applied: list[list[int]]) -> dict:
        """Write only the rows that changed as the next version."""
        version = prior["version"] + 1
        folder = f"d={version}-{uuid.uuid4().hex[:8]}"
        seen = Observation("changes")
        (changed.select(*table.warehouse_struct.fieldNames(), F.lit(version).cast("long").alias(VERSION))
            .observe(seen, F.count(F.lit(1)).alias("n"))
            .write.mode("errorifexists").parquet(f"{self.table_dir(table)}/{folder}"))
        rows = int(seen.get["n"])
        return self._commit(table, prior, hwm=int(hwm), batch=int(batch), applied=applied, base=prior["base"],
                            deltas=prior["deltas"] + [folder], base_rows=prior["base_rows"],
                            delta_rows=prior["delta_rows"] + rows, written=rows)

    def location(self, table: TableContract) -> str:
        """Folder that holds the whole newest version, for a catalog; changes are folded in first."""
        self.compact(table)
        return f"{self.table_dir(table)}/{self.current_meta(table)['base']}"

    def compact(self, table: TableContract) -> int | None:
        """Write the newest version as a base; nothing to do if it is one."""
        meta = self.current_meta(table)
        if meta is None or not meta["deltas"]:
            return None
        return self.publish(table, self._state(table, meta), meta["hwm"], meta["batch"], meta["applied"], meta)

    # -- apply -------------------------------------------------------------
    def typed_keys(self, table: TableContract, keys: DataFrame) -> DataFrame:
        """Lake keys (``primary_key``) as the table's key column."""
        pk = table.single_pk
        return keys.select(F.col("primary_key").cast(table.column(pk).dtype).alias(pk))

    def _fold_on(self, table: TableContract, prior: DataFrame, events: DataFrame) -> DataFrame:
        """Prior rows (of the keys concerned) and events that come after them, folded."""
        base = fold_mod.snapshot_event_form(prior, table)
        return fold_mod.fold_event_form(base.unionByName(fold_mod.event_form(events, table)), table)

    def version_below(self, table: TableContract, sequence: int) -> dict | None:
        """The newest version that holds nothing at or above ``sequence`` (marks never fall)."""
        newest = self.current_meta(table)
        lo, hi, found = 1, newest["version"] if newest else 0, None
        while lo <= hi:
            mid = (lo + hi) // 2
            meta = self.meta(table, mid)
            if meta is not None and meta["hwm"] < sequence:
                found, lo = meta, mid + 1
            else:
                hi = mid - 1
        return found

    def state_from(self, table: TableContract, lake_path: str, start: dict | None, keys: DataFrame | None = None,
                   target: int | None = None) -> DataFrame:
        """Rows as of ``target`` (default: of everything in the lake) from the version
        ``start`` and the batches it does not hold; of some lake keys (column
        ``primary_key``) or of all.  Keys with an event older than the version's mark
        are folded from their whole history."""
        from tidemark.operators.history import before_point
        pk = table.single_pk
        mine = lambda df: df.where(F.col("table_name") == table.name)
        cut = (lambda df: before_point(df, target)) if target is not None else (lambda df: df)
        some = (lambda df: df.join(keys, "primary_key", "left_semi")) if keys is not None else (lambda df: df)
        whole = lambda of: fold_mod.fold(cut(mine(lake_mod.read_lake(self.spark, lake_path, hi=target))).join(
            of, "primary_key", "left_semi"), table)
        if start is None:
            events = cut(mine(lake_mod.read_lake(self.spark, lake_path, hi=target)))
            return fold_mod.fold(some(events), table)
        log = lake_mod.read_log(self.spark, lake_path)
        since = [b for b in log.started if not holds(start, b)]
        since = [b for b in since if b in log.open or log.covered(b) or (
            log.committed.get(b) and (target is None or log.committed[b][0] <= target))]
        rest = some(cut(mine(lake_mod.read_batches(self.spark, lake_path, since, log))))
        prior = self._state(table, start)
        if keys is not None:
            prior = prior.join(self.typed_keys(table, keys), pk, "left_semi")
        # marker names tell whether any of these batches reaches below the version
        tail = all(log.committed.get(b) and log.committed[b][0] > start["hwm"] for b in since)
        per_key = rest.groupBy("primary_key").agg(F.max(lake_mod.is_late(start["hwm"])).alias("_late"))
        fresh = rest if tail else rest.join(per_key.where("not _late"), "primary_key", "left_semi")
        touched = self.typed_keys(table, rest.select("primary_key").distinct())
        out = prior.join(touched, pk, "left_anti").unionByName(
            self._fold_on(table, prior.join(self.typed_keys(table, fresh.select("primary_key").distinct()), pk, "left_semi"), fresh))
        return out if tail else out.unionByName(whole(per_key.where("_late").select("primary_key")))

    def changed(self, table: TableContract, prior: DataFrame, delta: DataFrame, lake_path: str, path: str,
                hwm: int, lowest: int) -> DataFrame:
        """The new rows of the keys that ``delta`` touches.

        ``path``: "fast" (no event is late: fold each touched key's prior row with
        its new events), "general" (every event is late: see ``state_from``) or
        "mixed" (routed per key by whether any of its events is late)."""
        def fresh(keys: DataFrame, events: DataFrame) -> DataFrame:
            return self._fold_on(table, prior.join(self.typed_keys(table, keys), table.single_pk, "left_semi"), events)

        def late(keys: DataFrame) -> DataFrame:
            return self.state_from(table, lake_path, self.version_below(table, lowest), keys)

        if path == "fast":
            return fresh(delta.select("primary_key").distinct(), delta)
        if path == "general":
            return late(delta.select("primary_key").distinct())
        per_key = delta.groupBy("primary_key").agg(F.max(lake_mod.is_late(hwm)).alias("_late"))
        calm = per_key.where("not _late").select("primary_key")
        return fresh(calm, delta.join(calm, "primary_key", "left_semi")).unionByName(
            late(per_key.where("_late").select("primary_key")))

    def apply(self, lake_path: str, delta: DataFrame, batch_id: int,
              table_stats: dict | None = None) -> list[ApplyReport]:
        """Apply the lake rows of one ingest batch (``delta``: stored lake rows).
        ``table_stats`` (table -> (rows, min seq, max seq)), when the caller
        observed them while writing the batch, saves one pass over it."""
        if table_stats is None:
            # contract tables only: what is collected does not grow with names in the data
            stats = {r["table_name"]: r.asDict() for r in
                     delta.where(F.col("table_name").isin(*self.contract.names))
                     .groupBy("table_name").agg(F.count(F.lit(1)).alias("n"), F.min("sequence").alias("lo"),
                                                F.max("sequence").alias("hi")).collect()}
        else:
            stats = {t: {"n": v[0], "lo": v[1], "hi": v[2]} for t, v in table_stats.items()}
        todo = [t for t in self.contract.tables if t.name in stats]

        def one(table: TableContract) -> ApplyReport:
            while True:
                try:
                    return self._apply_table(lake_path, table, delta, batch_id, stats[table.name])
                except FileExistsError:     # another run committed this version first
                    continue

        # Tables are independent: their merges run as concurrent Spark jobs.
        if len(todo) > 1:
            with ThreadPoolExecutor(max_workers=min(len(todo), self.parallel_tables)) as pool:
                reports = list(pool.map(one, todo))
        else:
            reports = [one(t) for t in todo]
        try:
            fs.write_json_atomic(self.spark, f"{self.root}/_cursor/{batch_id:020d}.json", {"batch": int(batch_id)})
        except FileExistsError:
            pass
        return reports

    def _apply_table(self, lake_path: str, table: TableContract, delta: DataFrame, batch_id: int, st: dict) -> ApplyReport:
        meta = self.current_meta(table)
        if holds(meta, batch_id):
            return ApplyReport(table.name, "skipped", meta["version"], st["n"])
        hwm = meta["hwm"] if meta else 0
        mine = delta.where(F.col("table_name") == table.name)
        late = 0 if st["lo"] > hwm else mine.where(lake_mod.is_late(hwm)).count()
        path = "fast" if late == 0 else ("general" if late == st["n"] else "mixed")
        prior = self._state(table, meta)
        changed = self.changed(table, prior, mine, lake_path, path, hwm, st["lo"])
        applied = merged((meta["applied"] if meta else []) + [[batch_id, batch_id]])
        top = max(hwm, st["hi"])
        if meta is None:
            self.publish(table, changed, top, batch_id, applied)
        elif len(meta["deltas"]) + 1 >= MOST_DELTAS or meta["delta_rows"] >= FOLD_AT * max(meta["base_rows"], 1):
            touched = self.typed_keys(table, mine.select("primary_key").distinct())
            self.publish(table, prior.join(touched, table.single_pk, "left_anti").unionByName(changed), top, batch_id,
                         applied, meta)
        else:
            self.publish_changes(table, meta, changed, top, batch_id, applied)
        new = self.meta(table, (meta["version"] if meta else 0) + 1)
        return ApplyReport(table.name, path, new["version"], st["n"], late, new["written"])

    def marks(self) -> dict[str, int]:
        """High-water mark (highest applied sequence) per table."""
        out = {}
        for t in self.contract.tables:
            m = self.current_meta(t)
            out[t.name] = m["hwm"] if m else 0
        return out

    def applied_batches(self) -> list[int]:
        """Warehouse cursor: lake ingest batches fully applied."""
        return sorted(int(n.split(".")[0]) for n in fs.list_names(self.spark, f"{self.root}/_cursor")
                      if n.endswith(".json") and not n.startswith("."))

    def rebuild(self, lake: DataFrame) -> dict[str, int]:
        """K7: fold the whole lake into fresh versions of every table."""
        bounds = {r["table_name"]: r for r in lake.where(F.col("table_name").isin(*self.contract.names))
                  .groupBy("table_name").agg(F.max("sequence").alias("hi"), F.max(INGEST_BATCH).alias("b")).collect()}
        # one number per batch
        applied = ranges(r[0] for r in lake.select(INGEST_BATCH).distinct().collect())

        def one(table):
            b = bounds.get(table.name)
            events = lake.where(F.col("table_name") == table.name)
            return table.name, self.publish(table, fold_mod.fold(events, table),
                                            b["hi"] if b else 0, b["b"] if b else 0, applied)
        with ThreadPoolExecutor(max_workers=min(len(self.contract.tables), self.parallel_tables)) as pool:
            return dict(pool.map(one, self.contract.tables))

    # -- time travel (K1, K5) ------------------------------------------------
    def asof(self, table: TableContract | str, lake_path: str, target: int) -> DataFrame:
        """K1 from the nearest version: active rows as of ``sequence <= target``."""
        if isinstance(table, str):
            table = self.contract.table(table)
        rows = self.state_from(table, lake_path, self.version_below(table, target), target=target)
        return fold_mod.active(rows)

    def touched(self, table: TableContract, lake_path: str, low: int, high: int | None = None) -> DataFrame:
        """Keys (``primary_key``) with an event after ``low``, up to ``high``; a restore
        cut at ``low`` comes after it.  Only folders of that range are opened."""
        rows = lake_mod.read_lake(self.spark, lake_path, lo=low, hi=high).where(F.col("table_name") == table.name)
        after = (F.col("sequence") > low) | (F.col(RESTORE_NO) > 0)
        if high is not None:
            after = after & ((F.col("sequence") < high) | (F.col(RESTORE_NO) == 0))
        return rows.where(after).select("primary_key").distinct()

    def diff(self, table: TableContract | str, lake_path: str, low: int, high: int) -> DataFrame:
        """K5: keys added, removed or changed between two sequences.  Keys come from the
        events between the two points, and both states are built for these only."""
        from tidemark.operators import history
        if isinstance(table, str):
            table = self.contract.table(table)
        keys = self.touched(table, lake_path, low, high)
        before, after = (fold_mod.active(self.state_from(table, lake_path, self.version_below(table, at), keys, at))
                         for at in (low, high))
        return history.diff(before, after, [table.single_pk], fold_mod.value_columns(table))


def fold_tables(lake: DataFrame, contract: Contract, mode: str = "patch") -> dict[str, DataFrame]:
    """Rebuild every contract table from lake rows without writing."""
    return {t.name: fold_mod.fold(lake.where(F.col("table_name") == t.name), t, mode)
            for t in contract.tables}


def union_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Same-schema tables stacked with a ``table_name`` column."""
    out = None
    for name, df in tables.items():
        df = df.select(F.lit(name).alias("table_name"), *df.columns)
        out = df if out is None else out.unionByName(df)
    return out
