"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf.  The leaves of one language, in ascending doc_id order, form
a tree of fan-out 8; the roots of the languages, null first and then bytewise,
form the tree above them.

A node's label is (level, index), so children come before their parent, and a
priority queue ordered by label delivers each child's digest to its parent just
when the parent is next (forward sweep).  The queue is external: Spark's sorted
shuffle holds the messages that cross from one block of ``SPAN`` = 8^4 nodes to
the level above the block, and inside a block, which one task reads in label
order, a heap of at most ``SPAN`` messages does.  A forest of N leaves takes
log(N) / log(SPAN) such rounds, whatever share of the rows one language has.

The sweep back runs the same blocks from the top: a block's root gets the proof
that leads from it to the root of everything (its *suffix*: per level the run's
digests left and right of the path), and a queue in descending label order hands
every child its run and its parent's suffix, down to the leaves.  A block gets
one suffix, not one per leaf.

Digests are SHA-256; a node hashes the lower-case hex text of its children.

Defined results: of rows with one doc_id the one with the smaller digest comes
first, rows without an id before all others, and they are never tampered with;
a column the table lacks counts as null; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import heapq
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, shuffle_width, stored, with_missing_columns
from tidemark.llm.decontaminate import LOWER, UPPER

FAN = 8
LEVELS = 4
SPAN = FAN ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*children: str) -> str:
    return sha256("".join(children).encode()).hexdigest()


# ---- one block: both sweeps ---------------------------------------------------

def climb(nodes: list[str], first: int, total: int) -> tuple[str, dict]:
    """Forward sweep over consecutive nodes of a tree that has ``total`` of them on
    this level: the digest at the top of the block and the run below each label."""
    queue = [(0, first + k, d) for k, d in enumerate(nodes)]        # sorted, so a heap
    runs: dict[tuple[int, int], list[str]] = {}
    while True:
        level, index, value = queue[0]
        if level == LEVELS or -(-total // FAN ** level) <= 1:
            return value, runs
        label, run = (level + 1, index // FAN), []
        while queue and (queue[0][0], queue[0][1] // FAN) == (level, index // FAN):
            run.append(heapq.heappop(queue)[2])
        runs[label] = run
        heapq.heappush(queue, (*label, digest(*run)))


def descend(runs: dict, first: int, count: int) -> list[list[tuple[str, str]]]:
    """Sweep back: for each node of the block its path upwards as (left, right) texts."""
    if not runs:
        return [[] for _ in range(count)]
    level, index = max(runs)
    queue = [(-level, index, [])]
    out: list[list[tuple[str, str]]] = [[]] * count
    while queue:
        level, index, path = heapq.heappop(queue)
        level = -level
        if not level:
            out[index - first] = path
            continue
        run = runs[level, index]
        for k in range(len(run)):
            step = ("".join(run[:k]), "".join(run[k + 1:]))
            heapq.heappush(queue, (1 - level, index * FAN + k, [step, *path]))
    return out


def pack(path: list[tuple[str, str]]) -> bytes:
    """A path as bytes: digests left and right of each step, counted."""
    return b"".join(bytes([len(a) // 64, len(b) // 64]) + bytes.fromhex(a + b) for a, b in path)


def unpack(raw: bytes | None) -> list[tuple[str, str]]:
    out, at = [], 0
    while raw and at < len(raw):
        a, b = raw[at], raw[at + 1]
        both = raw[at + 2:at + 2 + 32 * (a + b)].hex()
        out.append((both[:64 * a], both[64 * a:]))
        at += 2 + 32 * (a + b)
    return out


def fold(value: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        value = digest(left, value, right)
    return value


def _blocks_of(batches):
    """(first row with the block's suffix or None, the block's rows) from rows sorted by tree, block, idx."""
    key, head, rows = None, None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if row[:2] != key:
                if rows:
                    yield head, rows
                key, head, rows = row[:2], None, []
            if row[2] < 0:
                head = row
            else:
                rows.append(row)
    if rows:
        yield head, rows


def _some(rows, names, kinds, size: int = 4096):
    batch = []
    for row in rows:
        batch.append(row)
        if len(batch) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*batch), kinds)], names=names)
            batch = []
    if batch:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*batch), kinds)], names=names)


_NODE = "tree string, idx long, n long, d binary"
_NODE_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.binary()]


def _up(batches):
    def rows():
        for _, block in _blocks_of(batches):
            tree, number, first, n = block[0][:4]
            top, _ = climb([r[4].hex() for r in block], first, n)
            yield tree, number, -(-n // SPAN), bytes.fromhex(top)
    return _some(rows(), ["tree", "idx", "n", "d"], _NODE_KINDS)


def _down(batches):
    def rows():
        for head, block in _blocks_of(batches):
            tree, _, first, n = block[0][:4]
            _, runs = climb([r[4].hex() for r in block], first, n)
            for row, path in zip(block, descend(runs, first, len(block))):
                yield tree, row[2], pack(path) + (head[5] or b"")
    return _some(rows(), ["tree", "idx", "suffix"], [pa.string(), pa.int64(), pa.binary()], 512)


_RESULT = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def _leaves(root: str):
    def run(batches):
        def rows():
            for head, block in _blocks_of(batches):
                _, _, first, n = block[0][:4]
                subroot, above = head[8].hex(), unpack(head[5])
                rest = "".join(a + b for a, b in above)
                _, runs = climb([r[4].hex() for r in block], first, n)
                for row, path in zip(block, descend(runs, first, len(block))):
                    folded = fold(row[7].hex(), [*path, *above])
                    yield (row[6], row[4].hex(), subroot, root, digest(*[a + b for a, b in path], rest), folded, folded == root)
        kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        return _some(rows(), [c.split()[0] for c in _RESULT.split(", ")], kinds)
    return run


# ---- rounds -------------------------------------------------------------------

def numbered(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """``df`` with each row's place ``idx`` among the ``n`` rows of its tree.

    Rows are range-partitioned and stored once; counts per partition and tree
    (at most one row for each of both) give where a partition's rows start."""
    spark = df.sparkSession
    sort = ["tree", *order]
    # the id is made of the partition and the place in it
    placed = stored(df.repartitionByRange(shuffle_width(spark), *sort).sortWithinPartitions(*sort)
                    .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), name)
    runs = placed.groupBy("tree", "part").agg(F.min("at").alias("lo"), F.count("*").alias("size"))
    tree = Window.partitionBy("tree")
    before = F.sum("size").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("tree", "part", "lo", F.coalesce(before, F.lit(0)).alias("before"), F.sum("size").over(tree).alias("n"))
    return (placed.join(runs, ["tree", "part"]).withColumn("idx", F.col("at") - F.col("lo") + F.col("before"))
            .drop("at", "part", "lo", "before"))


def _by_block(nodes: DataFrame, extra: list[str], heads: DataFrame | None = None) -> DataFrame:
    """Rows (tree, block, idx, n, d, suffix, extra ...) with whole blocks in one task, in label order;
    a row of ``heads``, which is a node one round up with its suffix, comes before its block."""
    rows = nodes.select("tree", F.expr(f"idx div {SPAN}").alias("block"), "idx", "n", "d",
                        F.lit(None).cast("binary").alias("suffix"), *extra)
    if heads is not None:
        rows = rows.unionByName(heads.select("tree", F.col("idx").alias("block"), F.lit(-1).cast("long").alias("idx"),
                                             "suffix", *[c for c in extra if c in heads.columns]), allowMissingColumns=True)
    return rows.repartition(shuffle_width(nodes.sparkSession), "tree", "block").sortWithinPartitions("tree", "block", "idx")


def _forward(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Nodes of each round, from the given ones to one for each tree."""
    rounds = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        rounds.append(stored(_by_block(rounds[-1], []).mapInArrow(_up, _NODE), name))
        most = -(-most // SPAN)
    return rounds


def _back(rounds: list[DataFrame], heads: DataFrame, name: str) -> DataFrame:
    """Suffixes (tree, idx, suffix) of the nodes of the first round."""
    for nodes in reversed(rounds[:-1]):
        heads = stored(_by_block(nodes, [], heads).mapInArrow(_down, "tree string, idx long, suffix binary"), name)
    return heads


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: its leaf, subroot, root, proof, and the root folded from the (tampered) leaf."""
    docs = with_missing_columns(docs, doc_id="long", source="string", lang="string", n_chars="long", text="string")

    def leaf(**other) -> Column:
        fields = [other.get(c, F.col(c)).cast("string") for c in FIELDS]
        return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(x), F.lit(":"), x), F.lit("-")) for x in fields]), 256))

    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(F.coalesce(chosen, F.lit(False)), leaf(text=F.translate("text", UPPER, LOWER))).otherwise(leaf())
    rows = docs.select(F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"), "doc_id",
                       leaf().alias("d"), tampered.alias("given"))
    leaves = stored(numbered(rows, "ordered", "doc_id", "d"), "leaves")
    rounds = _forward(leaves, "nodes")

    subroots = rounds[-1].select("tree", "d")
    above = stored(numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "d"), "subroots", "of"), "above")
    over = _forward(above, "over")
    top = over[-1].select("d").first()
    if top is None:
        return docs.sparkSession.createDataFrame([], _RESULT)
    suffix = _back(over, over[-1].select("tree", "idx", F.lit(b"").alias("suffix")), "suffix")
    heads = above.join(suffix.select("idx", "suffix"), "idx").select(F.col("of").alias("tree"), F.col("d").alias("subroot"), "suffix")
    heads = stored(heads, "heads")
    # the rounds above the leaves' own blocks
    high = _back(rounds[1:], heads.select("tree", F.lit(0).cast("long").alias("idx"), "suffix"), "suffix")
    high = high.join(heads.select("tree", "subroot"), "tree")
    rows = _by_block(leaves.withColumn("subroot", F.lit(None).cast("binary")), ["doc_id", "given", "subroot"], high)
    return rows.mapInArrow(_leaves(top[0].hex()), _RESULT)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(documents(spark, sf_dir))


# ---- the same in DuckDB SQL, levels written out --------------------------------

def _oracle(lang_levels: int = 9, over_levels: int = 6) -> str:
    """Enough levels for 8^9 leaves a language and 8^6 languages."""
    field = lambda c: f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(c) if c != "text" else field(text) for c in FIELDS) + ")"
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    # one byte, then seven zeros: eight shifts of the checksum
    step = "xor(xor(c, x) >> 1, case when xor(c, x) & 1 = 1 then 3988292384 else 0 end)"
    crc = (f"xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(range(1, length(s) + 1), lambda k: "
           f"[ascii(substr(s, k, 1))::bigint, 0, 0, 0, 0, 0, 0, 0]))), lambda c, x: {step}), 4294967295)")
    out = [f"""docs as (select doc_id, lang, {leaf("text")} as leaf, {leaf(lower)} as lowered, doc_id::varchar as s from documents),
rows as (select doc_id, lang, leaf, case when s is not null and {crc} % 3 = 0 then lowered else leaf end as given,
  row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i from docs),
a0 as (select lang, i, count(*) over (partition by lang) as n, leaf as d from rows)"""]

    def levels(name: str, count: int, by: str) -> None:
        for k in range(count):
            both = f"partition by {by}i // 8 order by i rows between"
            out.append(f"""{name}{k + 1} as (select {by}i // 8 as i, (max(n) + 7) // 8 as n,
  case when max(n) = 1 then max(d) else sha256(string_agg(d, '' order by i)) end as d from {name}{k} group by {by}i // 8),
{name}s{k} as (select {by}i, n, coalesce(string_agg(d, '') over ({both} unbounded preceding and 1 preceding), '') as l,
  coalesce(string_agg(d, '') over ({both} 1 following and unbounded following), '') as r from {name}{k})""")

    def climb(name: str, frm: str, to: str, count: int, same: str) -> None:
        for k in range(count):
            out.append(f"""{to}{k + 1} as (select f.doc_id, f.lang, f.leaf, f.i // 8 as i, f.proof || s.l || s.r as proof,
  case when s.n = 1 then f.v else sha256(s.l || f.v || s.r) end as v
  from {frm if not k else to + str(k)} f join {name}s{k} s on {same}f.i = s.i)""")

    levels("a", lang_levels, "lang, ")
    out.append(f"""b0 as (select lang, d, row_number() over (order by lang nulls first) - 1 as i, count(*) over () as n from a{lang_levels})""")
    levels("b", over_levels, "")
    out.append("f0 as (select doc_id, lang, leaf, i, '' as proof, given as v from rows)")
    climb("a", "f0", "f", lang_levels, "f.lang is not distinct from s.lang and ")
    out.append(f"""g0 as (select f.doc_id, f.lang, f.leaf, b.i, f.proof, f.v from f{lang_levels} f
  join b0 b on f.lang is not distinct from b.lang)""")
    climb("b", "g0", "g", over_levels, "")
    return "with " + ",\n".join(out) + f"""
select g.doc_id, g.leaf, b.d as subroot, t.d as root, sha256(g.proof) as proof_sha256, g.v as folded_root, g.v = t.d as verified
from g{over_levels} g join b0 b on g.lang is not distinct from b.lang cross join b{over_levels} t"""


ORACLE = _oracle()
