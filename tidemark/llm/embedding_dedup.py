"""Near-duplicate embeddings by cross-polytope hashing.

A rotation is three rounds of random signs and a fast Walsh-Hadamard transform;
the hash of a vector is the axis, with its sign, that the rotated vector lies
closest to.  Several rotations make a table's bucket.  A vector stands in its
home bucket of every table and also looks into the next likely ones
(multiprobe: axes of smaller coordinates, least loss first).  Two vectors that
meet are a candidate, and a candidate is a link if its cosine, computed in double
precision, reaches the threshold.

How many rotations a table needs follows from the number of vectors, and how
many tables from a simulation: random pairs at exactly the threshold are hashed
and tables are added until a pair is missed with probability 1e-6 (``MISS``).

Dense groups are never paired up.  Equal vectors are one node.  Nodes of one
bucket that lie within half the threshold's angle of a common centre are a
*cell*: any two of them are linked, by the triangle inequality, so a cell is one
item with a centre, a radius and a count.  Items meet in buckets, not vectors, and
two items are judged by the angle of their centres and their radii: all their
members are linked, or none, and only where neither is certain the members are
compared one by one.  The centre comes from about ``SAMPLE`` members and affects
only how much is decided at once, never the result.

Defined results: a vector that is null, empty or zero, or that holds a null, an
infinity or a NaN links with nothing; vectors of different lengths do not link;
rows that repeat a vec_id are vectors of their own; rows without an id count as
links of others but never name a component; an empty table gives an empty result;
extra columns are not read.  If very many different vectors lie close to each
other and yet not within one cell, the pairs to check grow with their number squared.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import mix, stored, utf8
from tidemark.llm.near_dedup import components

COSINE = 0.95
MISS = 1e-6           # probability that a pair at the threshold meets in no table
PROBES = 4            # buckets of a table that a vector looks into, its home included
SAMPLE = 64           # members that a cell's centre is made of, about
SKETCH = 128          # bits of the sketch that candidates are compared by first
SLACK = 1e-6          # radians that a verdict by angles keeps from the threshold
_TRIALS = 4000
_STEP = 4096          # vectors hashed at a time
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


class Plan(NamedTuple):
    width: int        # length of a rotated vector, a power of two
    rotations: int    # per table
    tables: int
    limit: int        # bits in which the sketches of a link may differ


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    rows, n = x.shape
    half = 1
    while half < n:
        y = x.reshape(rows, n // (2 * half), 2, half)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), axis=2).reshape(rows, n)
        half *= 2
    return x / np.sqrt(n, dtype=x.dtype)


@functools.lru_cache(maxsize=4096)
def _signs(width: int, number: int) -> np.ndarray:
    return np.random.default_rng([width, number]).choice(np.array([-1, 1], np.float32), size=(3, width))


def rotate(x: np.ndarray, number: int) -> np.ndarray:
    for signs in _signs(x.shape[1], number):
        x = hadamard(x * signs)
    return x


def padded(unit: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(unit), width), np.float32)
    out[:, :unit.shape[1]] = unit
    return out


def _axes(x: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest axes of each rotated row and the loss of taking each."""
    r = rotate(x, number)
    size = np.abs(r)
    axis = np.argpartition(-size, PROBES, axis=1)[:, :PROBES]
    axis = np.take_along_axis(axis, np.argsort(-np.take_along_axis(size, axis, 1), axis=1), 1)
    best = np.take_along_axis(size, axis, 1)
    return axis * 2 + (np.take_along_axis(r, axis, 1) > 0), (best[:, :1] - best) ** 2


def table_buckets(x: np.ndarray, dims: int, table: int, rotations: int) -> np.ndarray:
    """(rows, PROBES) buckets of one table, home first."""
    axes, losses = zip(*[_axes(x, table * rotations + k) for k in range(rotations)])
    # a choice of ranks whose sum is s has at least s better ones, so these hold the best
    ranks = np.array([c for c in itertools.product(range(PROBES), repeat=rotations) if sum(c) < PROBES])
    loss = sum(losses[k][:, ranks[:, k]] for k in range(rotations))
    best = ranks[np.argsort(loss, axis=1, kind="stable")[:, :PROBES]]
    key = np.full((len(x), PROBES), np.uint64(table * 1_000_003 + dims))
    for k in range(rotations):
        key = mix(key * _MULTIPLY + np.take_along_axis(axes[k], best[:, :, k], 1).astype(np.uint64))
    return key.view(np.int64)


def sketches(x: np.ndarray) -> np.ndarray:
    """(rows, SKETCH) signs of coordinates under rotations of their own."""
    need = -(-SKETCH // x.shape[1])
    return np.concatenate([rotate(x, 1_000_000 + k) > 0 for k in range(need)], axis=1)[:, :SKETCH]


def plan(vectors: int, dims: int, cosine: float = COSINE) -> Plan:
    """Rotations so that buckets are about as many as vectors; tables by simulation."""
    width = max(16, 1 << (max(dims, 1) - 1).bit_length())
    rotations = 1
    while (2 * width) ** rotations < 2 * vectors:
        rotations += 1
    rng = np.random.default_rng(7)
    size = max(dims, 2)
    a, b = rng.normal(size=(2, _TRIALS, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = cosine * a + np.sqrt(1 - cosine ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    width = max(width, 1 << (size - 1).bit_length())
    x, y = padded(a, width), padded(b, width)
    left, tables = 1.0, 0
    trials = [(table_buckets(x, dims, t, rotations), table_buckets(y, dims, t, rotations)) for t in range(4)]
    met = np.mean([((p == q[:, :1]).any(axis=1) | (q == p[:, :1]).any(axis=1)).mean() for p, q in trials])
    while left > MISS:
        left *= 1 - 0.97 * met
        tables += 1
    differ = (sketches(x) != sketches(y)).sum(axis=1)
    return Plan(width, rotations, tables, int(min(SKETCH, np.ceil(differ.mean() + 7 * differ.std()))))


# ---- vectors as bytes -------------------------------------------------------

def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrices(kind: str, *columns: pa.Array):
    """(rows, unit vectors of each column) for each vector length; the columns agree in it."""
    parts = [utf8(c) for c in columns]
    size = np.diff(parts[0][1])
    for s in np.unique(size):
        rows = np.flatnonzero(size == s)
        if s:
            yield rows, *[_units(np.ascontiguousarray(data[off[rows][:, None] + np.arange(s)]).view(kind).astype(float))
                          for data, off in parts]


def _angle(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip((a * b).sum(axis=1), -1, 1))


def _rows(kind: str):
    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            n, size = len(lists), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(kind) + np.zeros(1, kind)   # null: NaN; -0: 0
            ends = np.cumsum(size)
            bad = np.bincount(np.searchsorted(ends, np.flatnonzero(~np.isfinite(flat)), side="right"), minlength=n)
            some = np.bincount(np.searchsorted(ends, np.flatnonzero(flat != 0), side="right"), minlength=n)
            raw, width = flat.tobytes(), flat.itemsize
            vec = [raw[(e - s) * width:e * width] if ok else None
                   for e, s, ok in zip(ends.tolist(), size.tolist(), ((bad == 0) & (some > 0)).tolist())]
            key = [None if v is None else hashlib.blake2b(v, digest_size=16).digest() for v in vec]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(key, pa.binary()), pa.array(vec, pa.binary())],
                                             names=["vec_id", "k", "vec"])
    return run


_SIGNED = "node long, m long, vec binary, home array<long>, probes array<long>, s1 long, s2 long"


def _sign(how: Plan, kind: str):
    def run(batches):
        for batch in batches:
            for lo in range(0, len(batch), _STEP):
                part = batch.slice(lo, _STEP)
                n = len(part)
                keys, bits = np.zeros((n, how.tables, PROBES), np.int64), np.zeros((n, SKETCH), bool)
                for rows, unit in _matrices(kind, part.column(2)):
                    x = padded(unit, how.width)
                    for t in range(how.tables):
                        keys[rows, t] = table_buckets(x, unit.shape[1], t, how.rotations)
                    bits[rows] = sketches(x)
                words = np.packbits(bits, axis=1).view(np.int64)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1)))
                         for x in (keys[:, :, 0], keys[:, :, 1:].reshape(n, -1))]
                yield pa.RecordBatch.from_arrays([*part.columns, *lists, pa.array(words[:, 0]), pa.array(words[:, 1])],
                                                 names=["node", "m", "vec", "home", "probes", "s1", "s2"])
    return run


def _centre(kind: str):
    """The mean direction of each row's vectors (they share a length)."""
    def run(batches):
        for batch in batches:
            out = []
            for some in batch.column(1).to_pylist():
                same = [v for v in some if len(v) == len(some[0])]
                mean = _units(np.frombuffer(b"".join(same), kind).reshape(len(same), -1).astype(float)).mean(axis=0)
                mean = mean.astype(kind)
                out.append(mean.tobytes() if mean.any() else some[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["bucket", "centre"])
    return run


def _core(kind: str, within: float):
    """Members no further than ``within`` from the centre, with their angle."""
    def run(batches):
        for batch in batches:
            angle = np.full(len(batch), np.inf)
            fits = pc.equal(pc.binary_length(batch.column(3)), pc.binary_length(batch.column(4))).to_numpy(zero_copy_only=False)
            take = np.flatnonzero(fits)
            part = batch.take(pa.array(take))
            for rows, a, b in _matrices(kind, part.column(3), part.column(4)):
                angle[take[rows]] = _angle(a, b)
            keep = pa.array(angle <= within)
            yield pa.RecordBatch.from_arrays([*[batch.column(k).filter(keep) for k in range(3)], pa.array(angle).filter(keep)],
                                             names=["bucket", "node", "m", "angle"])
    return run


def _judge(kind: str, cosine: float):
    """Columns: two keys, a number, two vectors, and the radius around each.  Keeps rows
    that are links as a whole ('all') and rows that angles alone cannot decide."""
    theta = np.arccos(cosine)

    def run(batches):
        for batch in batches:
            every, some = (np.zeros(len(batch), bool) for _ in range(2))
            reach = sum(batch.column(k).to_numpy(zero_copy_only=False) for k in (5, 6))
            sure = batch.column(3), batch.column(4)
            fits = pc.equal(*map(pc.binary_length, sure)).to_numpy(zero_copy_only=False)
            take = np.flatnonzero(fits)
            for rows, a, b in _matrices(kind, *[c.take(pa.array(take)) for c in sure]):
                rows, dot = take[rows], (a * b).sum(axis=1)
                angle, wide = np.arccos(np.clip(dot, -1, 1)), reach[rows]
                exact = wide == 0
                every[rows] = np.where(exact, dot >= cosine, angle + wide <= theta - SLACK)
                some[rows] = ~exact & (angle - wide <= theta + SLACK)
            keep = pa.array(every | some)
            yield pa.RecordBatch.from_arrays([*[batch.column(k).filter(keep) for k in range(3)], pa.array(every).filter(keep)],
                                             names=["a", "b", "m", "every"])
    return run


_JUDGED = "a long, b long, m long, every boolean"


def near_vectors(vectors: DataFrame, *, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    spark = vectors.sparkSession
    kind = "<f4" if vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType()) else "<f8"
    given = F.col("embedding").cast("array<float>" if kind == "<f4" else "array<double>")
    rows = stored(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), given.alias("embedding"))
                  .mapInArrow(_rows(kind), "vec_id long, k binary, vec binary"), "vectors")
    nodes = stored(rows.where("k is not null").groupBy("k")
                   .agg(F.count("*").alias("m"), F.min("vec_id").alias("lo"), F.first("vec").alias("vec"))
                   .withColumn("node", F.monotonically_increasing_id()), "nodes")
    n, size = nodes.agg(F.count("*"), F.max(F.length("vec"))).first()
    how = plan(n, (size or 0) // np.dtype(kind).itemsize, cosine)
    signed = stored(nodes.select("node", "m", "vec").mapInArrow(_sign(how, kind), _SIGNED), "signed")

    cells, placed = _cells(spark, signed, kind, np.arccos(cosine) / 2 - SLACK)
    items = stored(placed.where("not packed").select("item", F.col("vec").alias("centre"), F.lit(0.0).alias("radius"),
                                                     F.col("m").alias("total"))
                   .unionByName(cells.select("item", "centre", "radius", "total")), "items")
    pairs = _meetings(placed, how)
    side = lambda x: items.select(F.col("item").alias(x), F.col("centre").alias(f"vec_{x}"),
                                  F.col("radius").alias(f"r_{x}"))
    judged = stored(pairs.join(side("a"), "a").join(side("b"), "b").withColumn("m", F.lit(0).cast("long"))
                    .select("a", "b", "m", "vec_a", "vec_b", "r_a", "r_b").mapInArrow(_judge(kind, cosine), _JUDGED), "judged")

    # pairs of items that angles leave open: the members of one against the other
    # item, and what is still open member against member
    member = placed.select("item", "node", "m", "vec")
    large = items.select(F.col("item").alias("b"), F.col("centre"), F.col("radius"))
    opened = judged.where("not every").select("a", "b").join(
        items.select(F.col("item").alias("a"), F.col("total").alias("t_a")), "a").join(
        items.select(F.col("item").alias("b"), F.col("total").alias("t_b")), "b")
    opened = opened.select(F.when(F.col("t_a") <= F.col("t_b"), F.col("a")).otherwise(F.col("b")).alias("item"),
                           F.when(F.col("t_a") <= F.col("t_b"), F.col("b")).otherwise(F.col("a")).alias("b"))
    near = stored(opened.join(member, "item").join(large, "b")
                  .select(F.col("node").alias("a"), "b", "m", "vec", "centre", F.lit(0.0).alias("r_a"), F.col("radius").alias("r_b"))
                  .mapInArrow(_judge(kind, cosine), _JUDGED), "near")
    x, y = member.alias("x"), member.alias("y")
    single = stored(near.where("not every").select(F.col("a"), F.col("b").alias("of")).join(x, F.col("a") == F.col("x.node"))
                    .join(y, F.col("of") == F.col("y.item"))
                    .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.lit(0).cast("long").alias("m"),
                            F.col("x.vec"), F.col("y.vec").alias("vec_b"), F.lit(0.0).alias("r_a"), F.lit(0.0).alias("r_b"))
                    .mapInArrow(_judge(kind, cosine), _JUDGED), "single")

    whole, part = judged.where("every").select("a", "b"), near.where("every").select("a", "b", "m")
    total = items.select("item", "total")
    gain = lambda links, of, count, table, key, value: links.join(
        table.select(F.col(key).alias(count), F.col(value).alias("gain")), count).select(F.col(of).alias("at"), "gain")
    to_item = (gain(whole, "a", "b", total, "item", "total").unionByName(gain(whole, "b", "a", total, "item", "total"))
               .unionByName(part.select(F.col("b").alias("at"), F.col("m").alias("gain")))
               .groupBy(F.col("at").alias("item")).agg(F.sum("gain").alias("item_gain")))
    to_node = (gain(part, "a", "b", total, "item", "total")
               .unionByName(gain(single, "a", "b", member, "node", "m")).unionByName(gain(single, "b", "a", member, "node", "m"))
               .groupBy(F.col("at").alias("node")).agg(F.sum("gain").alias("node_gain")))

    item_of = placed.select("node", "item")
    edges = whole
    for links, ends in ((part, ("a",)), (single, ("a", "b"))):
        for end in ends:
            links = links.join(item_of.select(F.col("node").alias(end), F.col("item").alias(f"item_{end}")), end)
        edges = edges.unionByName(links.select("item_a" if "a" in ends else "a",
                                               "item_b" if "b" in ends else "b").toDF("a", "b"))
    labels = components(edges.distinct())

    found = (nodes.select("node", "k", "lo").join(item_of, "node").join(total, "item").join(to_item, "item", "left")
             .join(to_node, "node", "left").join(labels.select(F.col("node").alias("item"), "comp"), "item", "left")
             .select("k", "lo", F.coalesce("comp", "item").alias("comp"),
                     (F.col("total") - 1 + F.coalesce("item_gain", F.lit(0)) + F.coalesce("node_gain", F.lit(0))).alias("n")))
    found = stored(found, "found")
    least = found.groupBy("comp").agg(F.min("lo").alias("component"))
    answer = found.join(least, "comp").select("k", "n", "component")
    component = F.when(rows.k.isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return (rows.join(answer, "k", "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def _cells(spark: SparkSession, signed: DataFrame, kind: str, within: float) -> tuple[DataFrame, DataFrame]:
    """(cells, all nodes with their item): nodes of one bucket that lie within reach of its mean."""
    member = signed.select(F.element_at("home", 1).alias("bucket"), "node", "m", "vec")
    crowd = member.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    member = stored(member.join(crowd, "bucket"), "crowded")
    centre = stored(member.where(F.pmod(F.xxhash64("node"), F.col("n")) < SAMPLE).groupBy("bucket")
                    .agg(F.collect_list("vec").alias("some")).mapInArrow(_centre(kind), "bucket long, centre binary"), "centres")
    core = stored(member.join(centre, "bucket").select("bucket", "node", "m", "vec", "centre")
                  .mapInArrow(_core(kind, within), "bucket long, node long, m long, angle double"), "cores")
    cells = (core.groupBy("bucket").agg(F.min("node").alias("item"), F.count("*").alias("size"), F.sum("m").alias("total"),
                                        F.max("angle").alias("radius")).where("size > 1").join(centre, "bucket"))
    # a radius of 0 means a single vector below
    cells = stored(cells.withColumn("radius", F.greatest("radius", F.lit(SLACK))), "cells")
    inside = core.join(cells.select("bucket", "item"), "bucket").select("node", "item")
    placed = signed.join(inside, "node", "left").withColumn("packed", F.col("item").isNotNull())
    return cells, stored(placed.withColumn("item", F.coalesce("item", "node")), "placed")


def _meetings(placed: DataFrame, how: Plan) -> DataFrame:
    """Pairs of items (a < b) of which a member of one stands in a bucket that a member
    of the other stands in or looks into; single vectors only if their sketches are alike."""
    entry = lambda column, home: F.transform(column, lambda b: F.struct(b.alias("bucket"), F.lit(home).alias("home")))
    flat = placed.select("item", "packed", "s1", "s2", F.explode(F.concat(entry("home", 1), entry("probes", 0))).alias("e")).select(
        "item", "packed", "s1", "s2", "e.bucket", "e.home")
    of_cells = (flat.where("packed").groupBy("item", "bucket").agg(F.max("home").alias("home"))
                .select("item", F.lit(True).alias("packed"), F.lit(0).cast("long").alias("s1"),
                        F.lit(0).cast("long").alias("s2"), "bucket", "home"))
    entries = flat.where("not packed").unionByName(of_cells)
    x, y = entries.where("home = 1").alias("x"), entries.alias("y")
    differ = F.bit_count(F.col("x.s1").bitwiseXOR(F.col("y.s1"))) + F.bit_count(F.col("x.s2").bitwiseXOR(F.col("y.s2")))
    alike = F.col("x.packed") | F.col("y.packed") | (differ <= how.limit)
    met = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.item") != F.col("y.item")) & alike)
    return met.select(F.least("x.item", "y.item").alias("a"), F.greatest("x.item", "y.item").alias("b")).distinct()


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
