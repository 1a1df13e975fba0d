"""Helpers shared by the training-data operators.

Texts cross into Python as Arrow batches.  The helpers below look at a batch
as one UTF-8 byte buffer with row offsets, so the hot loops are numpy calls
over a few megabytes instead of Python calls per row.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text that one vectorised step looks at.  Some 60 bytes of arrays
# exist per byte of text, so this bounds a Python worker's memory.
SLICE_BYTES = 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

_RNG = np.random.default_rng(20)
_BYTE_VALUE = _RNG.integers(1, 1 << 63, size=(2, 256), dtype=np.uint64) | np.uint64(1)
_BASE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


# A single space between two of these characters separates words for every
# tokenizer here: ASCII, then letters of most scripts, none of them white space.
VISIBLE = "[!-~\u00c0-\u02af\u0370-\u167f\u3041-\ud7ff]"
WORD_CUT = re.compile(f"(?<={VISIBLE}) (?={VISIBLE})")
EDGE = re.compile(VISIBLE)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors see, below ``spark.checkpoint.dir``.

    Only a session that does not set it (tests) gets a local folder."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
    return f"{root.rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


# Bytes of an Arrow batch while a stage is written: either side of the pipe to
# Python holds a few batches per running task.
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back: a lineage cut that
    outlives executors and that several consumers can read without recomputing."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    before = spark.conf.get(_BATCH_CONF)
    spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH_CONF, before)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """Like ``stored``, in buckets by the hash of ``keys``, as many as a shuffle has
    partitions: joins on the keys move the other side only.  The table's name leaves
    the catalog at once, its files stay."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    before = spark.conf.get(_BATCH_CONF)
    spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    try:
        df.write.format("parquet").bucketBy(shuffle_width(spark), *keys).option("path", path).saveAsTable(table)
    finally:
        spark.conf.set(_BATCH_CONF, before)
    out = spark.table(table)
    spark.sql(f"DROP TABLE `{table}`")
    return out


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished stages now.  It does so when
    their plans are collected as garbage, which a driver with a roomy heap may
    put off until the disks are full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows, row offsets); null counts as empty."""
    col = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    col = col.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES):
    """The batch in runs of whole rows of about ``limit`` bytes of text."""
    col = batch.column(batch.schema.get_field_index(text))
    size = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    lo = 0
    while lo < len(batch):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, side="right"))
        hi = max(hi, lo + 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(low: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of lower-cased ``low`` and their rows.

    A word is a run of digits, a-z and characters outside ASCII, which in UTF-8
    is a run of bytes, so no decoding is needed.  Words stop at row ends."""
    n = len(low)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = _WORD[low]
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    edges = off[(off > 0) & (off < n)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    after[edges - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    rows = np.searchsorted(off, starts, side="right") - 1
    return starts, ends, rows


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    base = int(_BASE[which])
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.ones(size, np.uint64)
        p[1:] = np.uint64(b)
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, at least ``n``.

    A worker holds as many as its longest slice so far needed, once."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        size = (1 << 18) + 1
        while size < n:
            size = 2 * size - 1
        _POWERS[which] = _powers(which, size)
    return _POWERS[which]


def prefix_hash(data: np.ndarray, which: int = 0) -> np.ndarray:
    """S with hash(data[s:e]) = (S[e] - S[s]) * base^-s, modulo 2^64."""
    up, _ = powers(len(data) + 1, which)
    s = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[which][data] * up[:len(data)], out=s[1:])
    return s


def span_hash(s: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    _, down = powers(len(s), which)
    return mix((s[ends] - s[starts]) * down[starts])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ranges starts[i] .. starts[i] + counts[i] - 1."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, counts)


class Ragged:
    """Growing rows of ids."""

    def __init__(self):
        self.ids, self.starts, self.sizes, self.used, self.rows = np.zeros(1 << 16, np.int32), *(
            np.zeros(1 << 14, np.int64) for _ in range(2)), 0, 0

    @staticmethod
    def _room(x: np.ndarray, need: int) -> np.ndarray:
        return x if need <= len(x) else np.append(x, np.zeros(max(len(x), need - len(x)), x.dtype))

    def extend(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.ids = self._room(self.ids, self.used + len(ids))
        self.starts, self.sizes = (self._room(x, self.rows + len(sizes)) for x in (self.starts, self.sizes))
        self.ids[self.used:self.used + len(ids)] = ids
        self.starts[self.rows:self.rows + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[self.rows:self.rows + len(sizes)] = sizes
        self.used += len(ids)
        self.rows += len(sizes)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.sizes[rows]
        return self.ids[ragged(self.starts[rows], size)], size


def with_missing_columns(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, cast; one that ``df`` lacks is null."""
    return df.select(*[(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(k).alias(c)
                       for c, k in kinds.items()])
