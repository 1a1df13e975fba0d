"""Removal of repeated byte strings with suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere
else goes.  No suffix array of the whole corpus is built: equal strings have
equal contents, so they hold the same smallest gram (of ``GRAM`` bytes, by
hash) at the same place.  A document's window starts fall into runs that share
this *anchor*, and two windows can be equal only if their anchors are.

1. Rows of one text are one text; a text of ``LENGTH`` bytes that several rows
   hold is covered by itself and goes as a whole.  It still counts for others.
   Texts lie in buckets by their digest, so later steps bring their rows to them.
2. Every run of windows becomes one small row: anchor hash, digest of the bytes
   the run covers, document, first start, number of starts.
3. Rows whose anchor hash occurs once cannot repeat and go.
4. Rows with equal digests are one class of their anchor's group.
5. The bytes of a class's row, or of two of its rows if it has several, come
   together by group.  Two equal rows repeat as a whole.  The classes, each once,
   form one text; suffix arrays by linear grouping (``gsaca``) and common prefixes
   with suffix-array neighbours tell which windows of the others repeat.  Digests
   only bring rows together, bytes decide.
6. The windows found go back to all rows of the class and become byte spans.

A group of many classes (a passage that very many documents quote in different
surroundings) is cut finer before step 5: one row of each class is dealt again by
the bytes that all windows of a shorter range of starts have in common, so what is
not shared drops out and what is shared collapses.  At a range of one start a group
has one class, so group size is bounded without leaving anything out.

Defined results: null is the empty text; texts shorter than ``LENGTH`` lose
nothing; repeated rows repeat each other's strings, however many they are (the
work is that of one text); rows without an id or with the id of another are rows
of their own; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import (documents, mix, prefix_hash, ragged, release, shuffle_width, slices, span_hash, stored, stored_by,
                                 utf8)
from tidemark.llm.gsaca import repeated_windows, suffix_arrays

LENGTH, GRAM = 400, 32
# ranges of starts by which large groups are dealt again
FINER = (48, 6, 1)
CLASSES = 6                  # classes that one text may hold
BUNDLE = 2 << 20             # symbols of texts that one lockstep run handles, with some 25 bytes of arrays each
RUNS = 20_000                # classes whose runs are held before they are handed on
# bytes of text that are looked at in one step, with some 80 bytes of arrays each, and cut in one step
READ, COPY = 1 << 18, 1 << 20

# a longer document is read in tiles; places in a tile fit the low bits of a key
TILE, PLACE_BITS = 1 << 19, np.uint64(22)

# a text is known by the two halves of its 128-bit digest
_ROW = "h long, dg long, d1 long, d2 long, lo int, n int, anchor int"
_NAMES = ["h", "dg", "d1", "d2", "lo", "n", "anchor"]
DOC = ["d1", "d2"]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i + width] for every i, by minima from both ends of blocks."""
    n = len(x) - width + 1
    pad = -len(x) % width
    blocks = np.concatenate((x, np.full(pad, np.iinfo(x.dtype).max, x.dtype))).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchored_runs(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(row, first window start, windows, anchor, anchor hash, digest) of every run of
    windows with one anchor.  The anchor of a window is its gram of the smallest
    hash (of fixed precision), the first one of equal ones: it depends on the
    window's bytes alone."""
    n = len(data)
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    if n < length:
        return none
    sums = [prefix_hash(data, k) for k in (0, 1)]
    at = np.arange(n - gram + 1)
    h = span_hash(sums[0], at, at + gram)
    key = (h >> PLACE_BITS << PLACE_BITS) | at.astype(np.uint64)
    low = sliding_min(key, length - gram + 1)
    anchor = (low & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    # windows that lie in one row
    size = np.diff(off)
    starts = ragged(off[:-1], np.maximum(size - length + 1, 0))
    if not len(starts):
        return none
    mine = anchor[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (mine[1:] != mine[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    lo = starts[first]
    hi = lo + count - 1 + length
    place = (mine[first] - lo).astype(np.uint64)
    digest = mix(span_hash(sums[0], lo, hi) ^ mix(span_hash(sums[1], lo, hi, 1) + place))
    row = np.searchsorted(off, lo, side="right") - 1
    return row, lo - off[row], count, mine[first] - off[row], h[mine[first]], digest


def _anchors(batches):
    for batch in batches:
        for part in slices(batch, "text", READ):
            data, off = utf8(part.column(2))
            tiles = [(0, data, off)]
            if len(data) > TILE:          # the rows before a long one are short together
                tiles = []
                for r in range(len(part)):
                    for a in range(0, max(1, int(off[r + 1] - off[r]) - LENGTH + 1), TILE - LENGTH):
                        one = data[off[r] + a:min(off[r] + a + TILE - 1, off[r + 1])]
                        tiles.append((a, one, np.concatenate((np.zeros(r + 1, np.int64), np.full(len(part) - r, len(one))))))
            for shift, bytes_, bounds in tiles:
                row, lo, n, anchor, h, dg = anchored_runs(bytes_, bounds)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.astype(np.int64)), pa.array(dg.astype(np.int64)), part.column(0).take(take),
                     part.column(1).take(take), pa.array(lo + shift, pa.int32()), pa.array(n, pa.int32()),
                     pa.array(anchor + shift, pa.int32())], names=_NAMES)


def _finer(step: int):
    """Runs dealt again: at most ``step`` starts each, keyed by the bytes all their windows share.

    Ranges of starts are counted from the run's anchor, that is from the bytes,
    so equal windows still meet; a range that the run's end cuts off keeps the
    key of the whole range."""
    def deal(batches):
        for batch in batches:
            for part in slices(batch, "text", READ):
                data, off = utf8(part.column(2))
                sums = [prefix_hash(data, k) for k in (0, 1)]
                runs = part.column(3)
                row = np.repeat(np.arange(len(part)), pc.list_value_length(runs).to_numpy())
                flat = runs.flatten()
                lo, n, anchor = (flat.field(c).to_numpy().astype(np.int64) for c in ("lo", "n", "anchor"))
                # starts lie anchor - start = near .. far symbols before the anchor
                far = anchor - lo
                near = far - n + 1
                count = far // step - near // step + 1
                j = ragged(near // step, count)
                row, anchor, far, near = (np.repeat(x, count) for x in (row, anchor, far, near))
                first = anchor - np.minimum(far, j * step + step - 1)
                last = anchor - np.maximum(near, j * step)
                at = off[row]
                core = at + anchor - j * step
                h = mix(span_hash(sums[0], core, core + LENGTH - step + 1)
                        ^ mix(span_hash(sums[1], core, core + LENGTH - step + 1, 1) + np.uint64(step)))
                dg = mix(span_hash(sums[0], at + first, at + last + LENGTH)
                         ^ mix(span_hash(sums[1], at + first, at + last + LENGTH, 1) + (core - at - first).astype(np.uint64)))
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.astype(np.int64)), pa.array(dg.astype(np.int64)), part.column(0).take(take),
                     part.column(1).take(take), pa.array(first, pa.int32()), pa.array(last - first + 1, pa.int32()),
                     pa.array(anchor, pa.int32())], names=_NAMES)
    return deal


def _segments(batches):
    """The bytes of each class, from a document that stands for it."""
    for batch in batches:
        for part in slices(batch, "text", COPY):
            texts, lists = part.column(2), part.column(3).to_pylist()
            out = []
            for r, classes in enumerate(lists):
                text = texts[r].as_buffer()
                for c in classes:
                    out.append((c["h"], c["dg"], c["n"], text[c["lo"]:c["lo"] + c["n"] - 1 + LENGTH].to_pybytes()))
                    if len(out) == 4000:
                        yield _class_batch(out)
                        out = []
            if out:
                yield _class_batch(out)


def _class_batch(rows: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["h", "dg", "n", "bytes"])


_FIRST = 64           # symbols below are the separators of a text's segments, all different


def _group_text(classes: dict) -> tuple[np.ndarray, list]:
    """One text of a group's segments, and where the classes still open start in it."""
    parts, places, at = [], [], 0
    left = sum(len(segments) for _, segments, _ in classes.values())
    for dg, (n, segments, whole) in classes.items():
        if not whole:
            places.append((dg, at, n))
        for data in segments:
            left -= 1
            parts += [np.frombuffer(data, np.uint8).astype(np.uint16) + np.uint16(_FIRST), np.array([left], np.uint16)]
            at += len(data) + 1
    return np.concatenate(parts), places


_REPEATS = "h long, dg long, runs array<struct<a:int,b:int>>"


def _repeats(batches):
    """Runs of repeated windows (first and last) of each class; rows come ordered by group."""
    bundle, size, h, classes, keys, runs = [], 0, None, {}, [], []
    span = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def solve():
        texts = sorted(bundle, key=lambda x: len(x[1]))
        if texts:
            base = np.cumsum([0] + [len(x[1]) for x in texts])
            symbols = np.concatenate([x[1] for x in texts])
            flag = repeated_windows(symbols, base, suffix_arrays(symbols, base), LENGTH)
            for (group, _, places), start in zip(texts, base):
                for dg, at, n in places:
                    own = np.concatenate(([False], flag[start + at:start + at + n], [False]))
                    edge = np.flatnonzero(own[1:] != own[:-1])
                    if len(edge):
                        keys.append((group, dg))
                        runs.append([{"a": int(a), "b": int(b) - 1} for a, b in zip(edge[::2], edge[1::2])])
        out = pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
             pa.array(runs, span)], names=["h", "dg", "runs"])
        keys.clear()
        runs.clear()
        return out

    def close():
        nonlocal size
        for dg, known in classes.items():
            n, segments, _ = known
            if len(segments) == 2 and segments[0] == segments[1]:
                keys.append((h, dg))
                runs.append([{"a": 0, "b": n - 1}])
                known[1:] = segments[:1], True
        if any(not whole for _, _, whole in classes.values()) and sum(len(x) for _, x, _ in classes.values()) > 1:
            text, places = _group_text(classes)
            bundle.append((h, text, places))
            size += len(text)

    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        for group, dg, n, data in zip(*cols):
            if group != h:
                close()
                classes = {}
                h = group
                if size >= BUNDLE or len(keys) >= RUNS:
                    yield solve()
                    bundle, size = [], 0
            classes.setdefault(dg, [n, [], False])[1].append(data)
    close()
    if bundle or keys:
        yield solve()


def cut(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(starts and ends of the maximal removed runs, what is left)."""
    order = np.argsort(a)
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > b[:-1]
    starts = a[new]
    ends = b[np.append(np.flatnonzero(new)[1:] - 1, len(a) - 1)]
    left = zip(np.append(0, ends).tolist(), np.append(starts, len(data)).tolist())
    return starts, ends, b"".join(data[x:y].tobytes() for x, y in left)


_CUT = "d1 long, d2 long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _remove(with_bytes: bool):
    def remove(batches):
        for batch in batches:
            for part in slices(batch, "text", COPY):
                out, (data, off) = [], utf8(part.column(2))
                spans = part.column(3)
                at = np.append(0, np.cumsum(pc.list_value_length(spans).to_numpy()))
                a, b = (spans.flatten().field(c).to_numpy().astype(np.int64) for c in ("a", "b"))
                for r in range(len(part)):
                    starts, ends, kept = cut(data[off[r]:off[r + 1]], a[at[r]:at[r + 1]], b[at[r]:at[r + 1]])
                    out.append((int((ends - starts).sum()), len(starts), hashlib.sha256(kept).hexdigest(),
                                kept if with_bytes else None))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.string()), pa.array(cols[3], pa.binary())],
                    names=["d1", "d2", "n_removed", "n_spans", "kept_sha256", "kept"])
    return remove


def _classes(rows: DataFrame) -> DataFrame:
    """One row per class, with a row of it and, if it has several, another one."""
    row = F.struct("d1", "d2", "lo", "anchor")
    return (rows.groupBy("h", "dg").agg(F.first("n").alias("n"), F.min(row).alias("one"), F.max(row).alias("other"),
                                        F.count("*").alias("rows")))


def _recurring(rows: DataFrame) -> DataFrame:
    """Rows whose group has more than one row."""
    again = rows.groupBy("h").agg(F.count("*").alias("rows")).where("rows > 1").select("h")
    return rows.join(again, "h", "left_semi")


def _digest(text) -> list:
    hexed = F.md5(text)
    return [F.conv(F.substring(hexed, at, 16), 16, -10).cast("long").alias(name) for at, name in ((1, "d1"), (17, "d2"))]


def repeated_bytes(docs: DataFrame, *, with_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept) for every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.select("doc_id", *_digest("text"), "text")
    # each text once, whatever rows hold it; moved once, what is joined to it later comes to it
    texts = stored_by(docs.where(F.octet_length("text") >= LENGTH).groupBy(*DOC).agg(F.first("text").alias("text")), "texts", *DOC)
    release(spark)
    rows = stored(_recurring(stored(texts.mapInArrow(_anchors, _ROW), "anchors")), "recurring")
    release(spark)

    ready, classes = rows, None
    for step in (*FINER, None):
        own = stored(_classes(rows), "classes")
        large = stored(own.groupBy("h").agg(F.count("*").alias("k")).where(F.col("k") > CLASSES).select("h"), "large")
        # a class of several rows repeats as a whole, in a large group too
        decided = own.join(large, "h", "left_anti").unionByName(own.join(large, "h", "left_semi").where("rows > 1"))
        classes = decided if classes is None else classes.unionByName(decided)
        if step is None or not large.limit(1).count():
            break
        # one row stands for its class: what the others hold besides repeats already
        again = (own.join(large, "h", "left_semi").groupBy("one.d1", "one.d2")
                 .agg(F.collect_list(F.struct("one.lo", "n", "one.anchor")).alias("runs")))      # of one text: bounded by it
        rows = stored(_recurring(texts.join(again, DOC).select(*DOC, "text", "runs").mapInArrow(_finer(step), _ROW)), f"finer{step}")
        release(spark)
        # rows alone in their class in a large group find no runs there, their finer rows do
        ready = ready.unionByName(rows)

    classes = stored(classes, "all-classes")
    # a group of one row has nothing to repeat
    groups = classes.groupBy("h").agg(F.sum("rows").alias("all")).where("all > 1").select("h")
    held = classes.join(groups, "h", "left_semi").select("h", "dg", "n", F.explode(F.when(
        F.col("rows") > 1, F.array("one", "other")).otherwise(F.array("one"))).alias("at"))
    by_doc = held.groupBy("at.d1", "at.d2").agg(F.collect_list(F.struct("h", "dg", "n", F.col("at.lo").alias("lo"))).alias("classes"))
    segments = texts.join(by_doc, DOC).select(*DOC, "text", "classes").mapInArrow(
        _segments, "h long, dg long, n int, bytes binary")
    found = stored(segments.repartition(shuffle_width(spark), "h").sortWithinPartitions("h")
                   .mapInArrow(_repeats, _REPEATS), "repeats")
    release(spark)

    # a text that several rows hold goes as a whole
    size = F.octet_length("text").cast("long")
    whole = docs.select("doc_id", *DOC, size.alias("n_bytes"), F.sha2("text", 256).alias("whole_sha256"),
                        *([F.encode("text", "UTF-8").alias("whole")] if with_bytes else []))
    copies = stored(docs.where(size >= LENGTH).groupBy(*DOC).agg(F.count("*").alias("k"), F.first(size).alias("n_bytes"))
                    .where("k > 1").select(*DOC, "n_bytes"), "copies")
    spans = (ready.join(copies, DOC, "left_anti").join(found, ["h", "dg"]).select(*DOC, "lo", F.explode("runs").alias("run"))
             .groupBy(*DOC).agg(F.collect_list(F.struct(
                 (F.col("lo") + F.col("run.a")).alias("a"),
                 (F.col("lo") + F.col("run.b") + LENGTH).alias("b"))).alias("spans")))
    removed = texts.join(spans, DOC).select(*DOC, "text", "spans").mapInArrow(_remove(with_bytes), _CUT)
    nothing = F.lit(b"")
    removed = removed.unionByName(copies.select(*DOC, F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                                                F.sha2(nothing, 256).alias("kept_sha256"), nothing.alias("kept")))
    out = whole.join(removed, DOC, "left")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                      F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
                      F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
                      *([F.coalesce("kept", "whole").alias("kept")] if with_bytes else []))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(documents(spark, sf_dir))
