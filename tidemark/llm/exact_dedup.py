"""Exact dedup by Grace hashing.

Records are dealt to hash buckets through the shuffle, whose files are the
spill files.  A task streams its bucket through an open-addressing table that
compares complete contents.  The table's bytes are bounded; contents that no
longer fit leave the task as overflow records, which the next level deals anew
with other hash bits, until no overflow is left.  A content that is in the
table never overflows, and one that overflowed is in no table, so levels never
disagree.

Equal records are first merged inside each map task by the same table, so a
text that a third of all rows share reaches its bucket once per map task.

Defined results: null text is the empty text, and all empty texts are one
group; of equal texts the largest doc_id stays, a null doc_id counting as the
smallest; repeated rows count in ``group_size`` each; an empty table gives an
empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, lower_ascii, slices, stored, utf8

TABLE_BYTES = 24 << 20
FAN_OUT = 4096               # buckets of one shuffle; more are made inside each of them


class ContentTable:
    """Open addressing with linear probing over complete contents."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.slots = [-1] * 1024
        self.rows: list[list] = []   # [hash, content, largest id or None, count]
        self.bytes = 0

    def _grow(self) -> None:
        size = 2 * len(self.slots)
        self.slots = [-1] * size
        for k, row in enumerate(self.rows):
            i = row[0] & (size - 1)
            while self.slots[i] >= 0:
                i = (i + 1) & (size - 1)
            self.slots[i] = k

    def add(self, h: int, content: bytes, doc_id: int | None, count: int) -> bool:
        """False if the content is new and does not fit."""
        mask = len(self.slots) - 1
        i = h & mask
        while (k := self.slots[i]) >= 0:
            row = self.rows[k]
            if row[0] == h and row[1] == content:
                if row[2] is None or (doc_id is not None and doc_id > row[2]):
                    row[2] = doc_id
                row[3] += count
                return True
            i = (i + 1) & mask
        if self.rows and self.bytes + len(content) > self.limit:
            return False
        self.slots[i] = len(self.rows)
        self.rows.append([h, content, doc_id, count])
        self.bytes += len(content) + 100
        if 2 * len(self.rows) > len(self.slots):
            self._grow()
        return True


_RECORD = "hash long, doc_id long, n long, content binary"
_LEVEL = _RECORD + ", sha binary"


def _batch(rows: list, sha: bool | None = None) -> pa.RecordBatch:
    """Records; sha None: without the column, False: overflow, True: final."""
    cols = [pa.array([r[0] - (1 << 64) if r[0] >> 63 else r[0] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())]
    names = ["hash", "doc_id", "n", "content"]
    cols.append(pa.array([None if sha else r[1] for r in rows], pa.binary()))
    if sha is not None:
        cols.append(pa.array([hashlib.sha256(r[1]).digest() if sha else None for r in rows], pa.binary()))
        names.append("sha")
    return pa.RecordBatch.from_arrays(cols, names=names)


def _parts(rows: list, size: int = 8 << 20):
    """Runs of rows of a bounded number of content bytes."""
    run, n = [], 0
    for r in rows:
        run.append(r)
        n += len(r[1]) + 100
        if n >= size:
            yield run
            run, n = [], 0
    if run:
        yield run


def _contents(batch: pa.RecordBatch):
    """(doc_id, content with A-Z lower-cased) of each row."""
    for part in slices(batch, "text"):
        data, off = utf8(part.column(part.schema.get_field_index("text")))
        low = lower_ascii(data).tobytes()
        ids = part.column(part.schema.get_field_index("doc_id")).to_pylist()
        for k, doc_id in enumerate(ids):
            yield doc_id, low[off[k]:off[k + 1]]


def _combine(batches):
    """Merge equal rows of a map task; the table is emitted whenever it is full."""
    table = ContentTable(TABLE_BYTES)
    for batch in batches:
        for doc_id, content in _contents(batch):
            h = xxhash.xxh3_64_intdigest(content)
            if not table.add(h, content, doc_id, 1):
                for run in _parts(table.rows):
                    yield _batch(run)
                table.clear()
                table.add(h, content, doc_id, 1)
    for run in _parts(table.rows):
        yield _batch(run)


def _digests(batches):
    for batch in batches:
        pairs = [(i, hashlib.sha256(c).digest()) for i, c in _contents(batch)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.binary())],
            names=["doc_id", "sha"])


def _resolve(limit: int):
    def bucket(batches):
        table, over, size, inner = ContentTable(limit), [], 0, None
        for batch in batches:
            hashes = batch.column(0).to_numpy().astype(np.uint64).tolist()
            ids, counts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            contents, parts = batch.column(3), batch.column(4).to_pylist()
            for k, h in enumerate(hashes):
                content = contents[k].as_py()
                if parts[k] != inner:           # the records come ordered by inner bucket
                    for run in _parts(table.rows):
                        yield _batch(run, True)
                    table, inner = ContentTable(limit), parts[k]
                if not table.add(h, content, ids[k], counts[k]):
                    over.append([h, content, ids[k], counts[k]])
                    size += len(content)
                    if size > 4 << 20:
                        yield _batch(over, False)
                        over, size = [], 0
        if over:
            yield _batch(over, False)
        for run in _parts(table.rows):
            yield _batch(run, True)
    return bucket


def groups(docs: DataFrame, *, bucket_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per distinct content: sha, keep_id, group_size."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-2 * total // bucket_bytes))
    records = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_combine, _RECORD)
    done, level = None, 0
    while True:
        # a shuffle of at most FAN_OUT buckets; each is ordered by its inner buckets, which
        # Spark's sort spills, and every inner bucket gets a table of its own
        outer = int(min(buckets, FAN_OUT))
        inner = -(-int(buckets) // outer)
        place = F.xxhash64(F.lit(level), "hash")
        dealt = records.select(*records.columns, F.pmod(F.xxhash64(place, F.lit(1)), F.lit(inner)).alias("inner")).repartition(outer, place)
        dealt = dealt.sortWithinPartitions("inner") if inner > 1 else dealt
        out = stored(dealt.mapInArrow(_resolve(bucket_bytes), _LEVEL), f"grace{level}")
        final = out.where("sha is not null").select("sha", F.col("doc_id").alias("keep_id"),
                                                    F.col("n").alias("group_size"))
        done = final if done is None else done.unionByName(final)
        records = out.where("sha is null").drop("sha")
        left = records.agg(F.sum(F.octet_length("content"))).first()[0]
        if left is None:
            return done
        level += 1
        buckets = max(2, -(-4 * left // bucket_bytes))


def exact_dedup(docs: DataFrame, *, bucket_bytes: int = TABLE_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    members = docs.mapInArrow(_digests, "doc_id long, sha binary")
    found = groups(docs, bucket_bytes=bucket_bytes)
    return members.join(found, "sha").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


ORACLE = """
with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as x
           from documents),
g as (select x, max(doc_id) as keep_id, count(*) as group_size from t group by x)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.x) as text_sha256
from t join g on t.x = g.x
"""
