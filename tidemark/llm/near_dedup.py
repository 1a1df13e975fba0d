"""Near-duplicate classes by BagMinHash.

A text is the bag of its five-word shingles.  Signatures estimate the weighted
Jaccard similarity of bags without bias: every (shingle, weight level) runs a
Poisson process of points (time, register), and a register keeps the earliest
point.  Weights are discretised at integers and the levels are processed in
dyadic blocks 1, 1, 2, 4, ...: one process serves a whole block, and a point's
place in the block, found by halving, decides whether a weight that ends inside
the block has it.  Only points before a time at which all registers are almost
surely filled are drawn, so a signature costs little more than its bag.

Signatures are cut into bands.  Candidates are checked on the exact multiset
overlap, without pairing up whole buckets:

1. texts with equal word sequences are one node;
2. each bucket takes its most connected member as pivot, and every member is
   compared with the pivot (linear in the bucket);
3. connected components of the links found;
4. only pivots whose texts still form several components go on.  There a text is
   known by what it has more or less than the pivot, which is little, and the
   texts outside the pivot's component meet all others in blocks, as one matrix
   product of these differences a block (see ``_between``).  A block reports the
   components it joins, not its pairs, and no link of a candidate pair is lost.

With 32 bands of 4 a pair of similarity 0.8 is missed with probability 5e-8.

Defined results: a text without words is a class of its own; fewer than five
words are one shingle; every row is judged by its own text, whatever rows share
its doc_id; class_id is the smallest doc_id of the class, null if no row of the
class has one (all such rows are kept); an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import (documents, lower_ascii, mix, prefix_hash, ragged, release, shuffle_width, slices, span_hash, stored,
                                 utf8, word_bounds)

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
# members and difference tokens in a block of texts of one pivot, about
BLOCK_MEMBERS, BLOCK_TOKENS = 512, 1 << 19
POINTS = 8            # points drawn of a process at a time

_G = np.array([0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
               0x8EBC6AF09C88C6E3], dtype=np.uint64)


def shingles(low: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash of each shingle, words per row, two order-sensitive sums of word hashes per row)."""
    rows = len(off) - 1
    starts, ends, row = word_bounds(low, off)
    if not len(starts):
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), np.zeros(rows, np.int64), np.zeros((2, rows), np.uint64)
    word = span_hash(prefix_hash(low), starts, ends)
    n = np.bincount(row, minlength=rows)
    first = np.cumsum(n) - n
    place = (np.arange(len(word)) - first[row]).astype(np.uint64)
    sums = np.zeros((2, rows), np.uint64)
    have = n > 0
    for k in (0, 1):
        sums[k, have] = np.add.reduceat(mix(word + _G[k] * (place + np.uint64(1))), first[have])
    h = mix(word * _G[0])
    total = np.zeros(len(word), np.uint64)
    size = np.minimum(n, SHINGLE)[row]
    for j in range(SHINGLE):
        shifted = np.zeros(len(word), np.uint64)
        shifted[:len(word) - j] = h[j:]
        total += np.where(j < size, mix(shifted + _G[j]), np.uint64(0))
    ok = np.arange(len(word)) - first[row] <= (n[row] - size)
    return row[ok], mix(total[ok]), n, sums


def bags(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, multiplicity), ordered."""
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return row[at], h[at], np.diff(np.append(at, len(row)))


def _processes(row, h, weight):
    """(row, seed, block start, block size, weight) of every process that a bag's weights reach."""
    out = [(row, mix(h ^ _G[1]), np.zeros(len(row)), np.ones(len(row)), weight)]
    lo = 1
    live = weight > lo
    while live.any():
        r, s, w = row[live], h[live], weight[live]
        out.append((r, mix(mix(s ^ _G[1]) + np.uint64(lo)), np.full(len(r), float(lo)), np.full(len(r), float(lo)), w))
        lo *= 2
        live = weight > lo
    return [np.concatenate(x) for x in zip(*out)]


def signatures(row: np.ndarray, h: np.ndarray, weight: np.ndarray, rows: int,
               registers: int = REGISTERS) -> np.ndarray:
    """BagMinHash registers (rows x registers, times of first points as 64-bit patterns)."""
    out = np.full(rows * registers, np.inf)
    total = np.bincount(row, weights=weight, minlength=rows)
    todo = total > 0
    limit = np.zeros(rows)
    limit[todo] = (np.log(registers) + 5) / total[todo]
    p_row, seed, start, size, weight = _processes(row, h, weight.astype(float))
    while todo.any():
        live = np.flatnonzero(todo[p_row])
        base, step = np.zeros(len(live)), 0
        while len(live):
            k = np.arange(step * POINTS + 1, (step + 1) * POINTS + 1, dtype=np.uint64)
            r1 = mix(seed[live][:, None] + k * _G[2])
            r2 = mix(seed[live][:, None] + k * _G[3])
            gap = -np.log(((r1 >> np.uint64(11)).astype(float) + 0.5) / (1 << 53))
            times = base[:, None] + np.cumsum(gap, axis=1) / (registers * size[live])[:, None]
            inside = start[live][:, None] + (r2 & np.uint64((1 << 40) - 1)).astype(float) / (1 << 40) * size[live][:, None]
            ok = (times <= limit[p_row[live]][:, None]) & (inside < weight[live][:, None])
            i, j = np.nonzero(ok)
            register = ((r2[i, j] >> np.uint64(40)) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(out, p_row[live][i] * registers + register, times[i, j])
            base = times[:, -1]
            more = base <= limit[p_row[live]]
            live, base, step = live[more], base[more], step + 1
        todo &= np.isinf(out.reshape(rows, registers)).any(axis=1)
        limit[todo] *= 2
    return out.view(np.uint64).reshape(rows, registers)


_SIGNED = "doc_id long, th binary, k1 long, k2 long, size long, sig binary, bands array<long>"


def _sign(batches):
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            data, off = utf8(part.column(1))
            row, h, _, sums = shingles(lower_ascii(data), off)
            rows = len(part)
            row, h, weight = bags(row, h)
            size = np.bincount(row, weights=weight, minlength=rows).astype(np.int64)
            reg = signatures(row, h, weight, rows)
            key = np.zeros((rows, BANDS), np.uint64)
            for j in range(ROWS):
                key = mix(key * _G[0] + mix(reg[:, j::ROWS] + _G[j]))
            key = mix(key + np.arange(BANDS, dtype=np.uint64) * _G[4]).astype(np.int64)
            sig = (mix(reg) & np.uint64(255)).astype(np.uint8)
            offsets = np.concatenate(([0], np.cumsum(np.where(size > 0, BANDS, 0))))
            bands = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(key[size > 0].reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.int64)),
                 pa.array(size), pa.array([x.tobytes() for x in sig], pa.binary()), bands],
                names=["doc_id", "th", "k1", "k2", "size", "sig", "bands"])


def _sides(part: pa.RecordBatch):
    """Bags of the texts in columns 2 and 3, merged: (row, shingle, weight, side), ordered,
    and the sizes of either side."""
    rows, sides, sizes = len(part), [], []
    for k in (2, 3):
        data, off = utf8(part.column(k))
        row, h, weight = bags(*shingles(lower_ascii(data), off)[:2])
        sides.append((row, h, weight, np.full(len(row), k - 2)))
        sizes.append(np.bincount(row, weights=weight, minlength=rows).astype(np.int64))
    row, h, weight, side = (np.concatenate(x) for x in zip(*sides))
    order = np.lexsort((side, h, row))
    return row[order], h[order], weight[order], side[order], sizes


def _overlap(batches):
    """Exact multiset overlap of pairs of texts, and the sizes of both."""
    for batch in batches:
        for part in slices(batch, "text_a", 1 << 20):
            row, h, weight, _, sizes = _sides(part)
            same = np.flatnonzero((row[1:] == row[:-1]) & (h[1:] == h[:-1]))
            both = np.bincount(row[same], weights=np.minimum(weight[same], weight[same + 1]), minlength=len(part))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(both.astype(np.int64)), *map(pa.array, sizes)],
                names=["a", "b", "both", "size_a", "size_b"])


def _differences(batches):
    """What text a has more or less often than text b: one token for each time."""
    for batch in batches:
        for part in slices(batch, "text_a", 1 << 20):
            row, h, weight, side, _ = _sides(part)
            # the entry of the other side, if any, is next to it
            pair = np.flatnonzero((row[1:] == row[:-1]) & (h[1:] == h[:-1]))
            low, high = weight.copy(), weight.copy()
            low[pair] = np.minimum(weight[pair], weight[pair + 1])
            high[pair] = np.maximum(weight[pair], weight[pair + 1])
            single = np.ones(len(row), bool)
            single[pair] = single[pair + 1] = False
            low[single] = 0
            high[pair + 1] = low[pair + 1] = 0
            # the k-th occurrence of a shingle, for the k that one side alone has
            more = high - low
            token = mix(np.repeat(h, more) + ragged(low, more).astype(np.uint64)).astype(np.int64)
            count = np.bincount(row, weights=more, minlength=len(part)).astype(np.int64)
            offsets = pa.array(np.append(0, np.cumsum(count)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.ListArray.from_arrays(offsets, pa.array(token))], names=["a", "b", "tokens"])


def _joined(comp: np.ndarray, links: np.ndarray) -> list[int]:
    """For each component that ``links`` (members x members) connects with another
    one, a member of it and a member of the smallest one reached."""
    label = comp.copy()
    while True:
        least = np.where(links, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        least = np.minimum(label, least)
        group = np.unique(comp, return_inverse=True)[1]
        low = np.full(group.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(low, group, least)
        after = low[group]
        if (after == label).all():
            break
        label = after
    first = {c: k for k, c in reversed(list(enumerate(comp.tolist())))}
    return [(k, first[label[k]]) for c, k in first.items() if label[k] != c]


def _between(similarity: float):
    """Components joined by links between the texts of a block.

    Let x, y be bags, C their pivot, D(x) the difference of x and C.  Then
    |x & y| = |x & C| + |y & C| - |C| + |D(x) & D(y)|, all counted with multiplicity,
    so the overlaps of all pairs follow from one product of the differences, in
    which only tokens of several texts matter."""
    need = similarity / (1 + similarity)

    def block(rows):
        node, comp, size, base = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 2, 3))
        count = np.array([len(r[4]) for r in rows])
        token = np.concatenate([np.asarray(r[4], np.int64) for r in rows])
        row = np.repeat(np.arange(len(rows)), count)
        values, at, often = np.unique(token, return_inverse=True, return_counts=True)
        keep = np.cumsum(often > 1) - 1
        ok = (often > 1)[at]
        row, at, width = row[ok], keep[at[ok]], int((often > 1).sum())
        shared = np.zeros((len(rows), len(rows)), np.float32)
        order = np.argsort(at, kind="stable")
        row, at = row[order], at[order]
        for lo in range(0, width, 4096):
            a, b = np.searchsorted(at, [lo, lo + 4096])
            some = np.zeros((len(rows), min(4096, width - lo)), np.float32)
            some[row[a:b], at[a:b] - lo] = 1
            shared += some @ some.T
        both = (base[:, None] + base[None, :]) / 2 + shared
        links = both >= need * (size[:, None] + size[None, :]) - 1e-9
        return [(node[i], node[j]) for i, j in _joined(comp, links)]

    def run(batches):
        key, rows = None, []

        def out(pairs):
            return pa.RecordBatch.from_arrays([pa.array([int(x[k]) for x in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])
        for batch in batches:
            keys = list(zip(*[batch.column(k).to_pylist() for k in range(3)]))
            plain = [batch.column(k).to_pylist() for k in range(3, 7)]
            lists = batch.column(7)
            for k, this in enumerate(keys):
                if this != key:
                    if len(rows) > 1 and (found := block(rows)):
                        yield out(found)
                    key, rows = this, []
                rows.append((*[c[k] for c in plain], lists[k].values.to_numpy()))
        if len(rows) > 1 and (found := block(rows)):
            yield out(found)
    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node each node of ``edges`` (a, b) is connected to.

    Each round a node takes the smallest label around it and then its label's
    label; labels are written after each round, so a lost executor costs one."""
    links = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stored(links.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("comp")), "labels")
    while True:
        around = (links.join(labels.select(F.col("node").alias("b"), "comp"), "b")
                  .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        better = labels.join(around, "node").select(
            "node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = better.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        # a label is a node, so it has a label itself
        after = stored(better.join(jump, "comp").select("node", "old", F.least("comp", "far").alias("comp")), "labels")
        changed = after.where("comp <> old").limit(1).count()
        labels = after.select("node", "comp")
        if not changed:
            return labels


_OVERLAP = "a long, b long, both long, size_a long, size_b long"


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) with both texts.  Merge joins at every size: a pivot that very
    many texts are compared with is then split by the engine, not broadcast."""
    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")).hint("merge")
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")


def near_duplicates(docs: DataFrame, *, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, kept (one document of each class) for every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("th", F.unhex(F.md5("text")))
    signed = stored(docs.mapInArrow(_sign, _SIGNED), "signed")
    nodes = stored(
        signed.where("size > 0").groupBy("k1", "k2")
        .agg(F.min("doc_id").alias("least"), F.min("th").alias("th"), F.first("size").alias("size"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")

    # buckets of several nodes, and how connected each node is
    member = nodes.select("node", F.explode("bands").alias("bucket"))
    bucket = member.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    member = stored(member.join(bucket, "bucket"), "members")
    score = member.groupBy("node").agg(F.sum("n").alias("score"))
    scored = member.select("bucket", "node").join(score, "node")
    pivot = scored.groupBy("bucket").agg(F.max(F.struct("score", (-F.col("node")).alias("m"))).alias("p")).select(
        "bucket", (-F.col("p.m")).alias("pivot"))
    pairs = stored(member.join(pivot, "bucket").where("node <> pivot")
                   .select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct(), "pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = wanted.join(nodes.select("node", "th"), "node")
    # equal texts become one before they are joined
    texts = docs.groupBy("th").agg(F.first("text").alias("text")).hint("merge").join(wanted, "th")
    texts = stored(texts.select("node", "text"), "texts")

    release(docs.sparkSession)
    share = F.col("both") / (F.col("size_a") + F.col("size_b") - F.col("both"))
    tested = stored(_with_texts(pairs, texts).mapInArrow(_overlap, _OVERLAP), "tested")
    links = tested.where(share >= similarity).select("a", "b")
    labels = components(links)
    found = stored(_beyond(tested, labels, texts, similarity), "found")
    if found.limit(1).count():
        labels = components(links.unionByName(found))

    placed = nodes.select("k1", "k2", "node", "least").join(labels, "node", "left").select(
        "k1", "k2", "least", F.coalesce("comp", "node").alias("comp"))
    least = placed.groupBy("comp").agg(F.min("least").alias("class_id"))
    classes = placed.join(least, "comp").select("k1", "k2", "class_id")
    rows = signed.select("doc_id", "k1", "k2", "size")
    return (rows.join(classes, ["k1", "k2"], "left")
            .select("doc_id", F.when(F.col("size") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id"))))


def _beyond(tested: DataFrame, labels: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Edges between components whose texts were compared with the same pivot and are links.

    The texts outside the pivot's component are dealt into blocks, and all texts
    of the pivot into others; every block of the first meets every block of the
    second (and the first their own) in one task."""
    placed = (tested.join(labels.select(F.col("node").alias("a"), "comp"), "a", "left")
              .withColumn("comp", F.coalesce("comp", "a")))
    of_pivot = labels.select(F.col("node").alias("b"), F.col("comp").alias("c_pivot"))
    placed = placed.join(of_pivot, "b", "left").withColumn("c_pivot", F.coalesce("c_pivot", "b"))
    placed = placed.withColumn("outside", F.col("comp") != F.col("c_pivot"))
    # tokens that two bags differ in
    length = F.col("size_a") + F.col("size_b") - 2 * F.col("both")
    blocks = lambda count, total: F.ceil(F.greatest(count / BLOCK_MEMBERS, total / BLOCK_TOKENS, F.lit(1.0)))
    out = F.when(F.col("outside"), 1).otherwise(0)
    # a pivot whose texts are all in its component has nothing left to find
    live = (placed.groupBy("b").agg(F.sum(out).alias("n_out"), F.sum(out * length).alias("t_out"),
                                    F.count("*").alias("n"), F.sum(length).alias("t")).where("n_out > 0 and n > 1")
            .select("b", blocks(F.col("n_out"), F.col("t_out")).alias("x_blocks"), blocks(F.col("n"), F.col("t")).alias("y_blocks")))
    placed = placed.join(live, "b")
    tokens = _with_texts(placed.select("a", "b"), texts).mapInArrow(_differences, "a long, b long, tokens array<long>")
    base = 2 * F.col("both") - F.col("size_b")
    placed = stored(tokens.join(placed, ["a", "b"]).select(
        "a", "b", "comp", "outside", F.col("size_a").alias("size"), base.alias("base"), "tokens", "x_blocks", "y_blocks"), "placed")
    mine = F.pmod(F.xxhash64("a"), F.col("x_blocks"))
    other = F.pmod(F.xxhash64("a", F.lit(1)), F.col("y_blocks"))
    columns = [F.col("a").alias("node"), "comp", "size", "base", "tokens"]
    # a block of the first kind goes to every block of the second kind and back
    x = placed.where("outside").select("b", mine.alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("y_blocks") - 1)).alias("j"),
                                       *columns)
    y = (placed.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("x_blocks") - 1)).alias("i"), other.alias("j"),
                       *columns, F.when(F.col("outside"), mine).alias("own"))
         .where("own is null or own <> i").drop("own"))
    return (x.unionByName(y).repartition(shuffle_width(tested.sparkSession), "b", "i", "j").sortWithinPartitions("b", "i", "j")
            .select("b", "i", "j", "node", "comp", "size", "base", "tokens").mapInArrow(_between(similarity), "a long, b long").distinct())


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
