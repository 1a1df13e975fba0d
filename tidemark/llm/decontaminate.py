"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents of a few megabytes inside a map task.  Its words
become symbols of the benchmark's vocabulary; a word outside the vocabulary
can be in no window and becomes a break, and only runs between breaks that are
as long as the shortest window are indexed.  The index is a suffix order, its
Burrows-Wheeler transform in a wavelet matrix for ranks, and every eighth
suffix position.  All windows are searched backwards at once; their
occurrences are located by walking to a sampled position, and overlapping
occurrences merge into removal spans.

The benchmark comes in blocks of at most ``BLOCK_WINDOWS`` windows, one pass
over the documents each, so what a task gets does not grow with the benchmark.

Defined results: null has no words; an item without words matches nothing; an
item of fewer words than the window is one window; repeated documents are
answered each; an empty benchmark hits nothing; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import (documents, lower_ascii, prefix_hash, ragged, slices, span_hash, stored, utf8,
                                 word_bounds)

WINDOW = 10
BLOCK_WINDOWS = 100_000
SAMPLE = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``seq``, whose last symbol is its unique smallest."""
    n = len(seq)
    rank = seq.astype(np.int64)
    width = 1
    while True:
        after = np.full(n, -1, np.int64)
        after[:n - width] = rank[width:] if width < n else rank[:0]
        key = rank * (int(rank.max()) + 2) + after + 1
        order = np.argsort(key, kind="stable")
        fresh = np.empty(n, np.int64)
        ordered = key[order]
        fresh[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = fresh
        if rank[order[-1]] == n - 1:
            return order
        width *= 2


class WaveletMatrix:
    """Ranks of symbols over a sequence, one bit plane per level."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        cur = seq
        for level in reversed(range(self.bits)):
            bit = (cur >> level) & 1
            ones = np.zeros(len(cur) + 1, np.int64)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(cur) - int(ones[-1]))
            cur = np.concatenate((cur[bit == 0], cur[bit == 1]))

    def rank(self, symbol: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        lo = np.zeros_like(pos)
        for level, ones, zeros in zip(reversed(range(self.bits)), self.ones, self.zeros):
            bit = ((symbol >> level) & 1).astype(bool)
            pos1, lo1 = ones[pos], ones[lo]
            pos = np.where(bit, zeros + pos1, pos - pos1)
            lo = np.where(bit, zeros + lo1, lo - lo1)
        return pos - lo


class FMIndex:
    def __init__(self, seq: np.ndarray, symbols: int):
        """``seq`` ends in symbol 0, which stands nowhere else."""
        order = suffix_order(seq)
        self.bwt = seq[order - 1]
        self.wavelet = WaveletMatrix(self.bwt, symbols)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=symbols))))
        self.sampled = order % SAMPLE == 0
        self.slot = np.cumsum(self.sampled) - 1
        self.position = order[self.sampled]

    def search(self, phrases: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of all phrases (rows, left-aligned symbols), by backward search."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), len(self.bwt), np.int64)
        live = np.arange(len(phrases))
        for step in range(int(length.max(initial=0))):
            live = live[(length[live] > step) & (lo[live] < hi[live])]
            if not len(live):
                break
            c = phrases[live, length[live] - 1 - step]
            lo[live] = self.before[c] + self.wavelet.rank(c, lo[live])
            hi[live] = self.before[c] + self.wavelet.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back to a sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(~self.sampled[rows])
        while len(open_):
            c = self.bwt[rows[open_]]
            rows[open_] = self.before[c] + self.wavelet.rank(c, rows[open_])
            steps[open_] += 1
            open_ = open_[~self.sampled[rows[open_]]]
        return self.position[self.slot[rows]] + steps


class Windows:
    """A block of benchmark windows as vocabulary, phrases and the items of each."""

    def __init__(self, windows: list[str], items: list[str]):
        table = pd.DataFrame({"w": windows, "i": items}).drop_duplicates()
        phrase, names = pd.factorize(table["w"])
        order = np.argsort(phrase, kind="stable")
        self.items = table["i"].to_numpy()[order]
        self.item_start = np.searchsorted(phrase[order], np.arange(len(names) + 1))
        split = [w.split(" ") for w in names]
        vocabulary = sorted({x for w in split for x in w})
        raw = [x.encode() for x in vocabulary]
        off = np.cumsum([0] + [len(x) for x in raw])
        data = np.frombuffer(b"".join(raw), np.uint8)
        pair = [span_hash(prefix_hash(data, k), off[:-1], off[1:], k) for k in (0, 1)] if raw else [np.zeros(0, np.uint64)] * 2
        by = np.argsort(pair[0])
        self.hash, self.check = pair[0][by], pair[1][by]
        number = {vocabulary[k]: n + 2 for n, k in enumerate(by.tolist())}   # 0: end, 1: break
        self.length = np.array([len(w) for w in split], np.int64)
        self.phrases = np.zeros((len(split), int(self.length.max(initial=1))), np.int64)
        for k, w in enumerate(split):
            self.phrases[k, :len(w)] = [number[x] for x in w]
        self.symbols = len(vocabulary) + 2

    def symbols_of(self, low, starts, ends) -> np.ndarray:
        """Vocabulary number of each word, 1 if it has none (two 64-bit hashes decide)."""
        out = np.ones(len(starts), np.int64)
        if not len(self.hash) or not len(starts):
            return out
        h = span_hash(prefix_hash(low, 0), starts, ends, 0)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        hit = np.flatnonzero(self.hash[at] == h)
        if len(hit):
            ok = hit[span_hash(prefix_hash(low, 1), starts[hit], ends[hit], 1) == self.check[at[hit]]]
            out[ok] = at[ok] + 2
        return out


def find(block: Windows, low: np.ndarray, off: np.ndarray):
    """Per row of the shard: number of words, hit words, item lists and removal spans
    (first and last word, start and end byte)."""
    rows = len(off) - 1
    starts, ends, row = word_bounds(low, off)
    n_words = np.bincount(row, minlength=rows)
    items, spans = [[] for _ in range(rows)], [[] for _ in range(rows)]
    n_hit = np.zeros(rows, np.int64)
    if not len(block.length) or not len(starts):
        return n_words, n_hit, items, spans
    sym = block.symbols_of(low, starts, ends)
    known = sym > 1
    new = np.ones(len(sym), bool)
    new[1:] = (known[1:] != known[:-1]) | (row[1:] != row[:-1])
    run = np.flatnonzero(new)
    size = np.diff(np.append(run, len(sym)))
    keep = known[run] & (size >= block.length.min())
    run, size = run[keep], size[keep]
    if not len(run):
        return n_words, n_hit, items, spans
    # a break after every run, then the end symbol
    word = ragged(run, size + 1)
    stop = np.cumsum(size + 1) - 1
    word[stop] = -1
    seq = np.where(word < 0, 1, sym[word])
    index = FMIndex(np.append(seq, 0), block.symbols)
    lo, hi = index.search(block.phrases, block.length)
    found = np.flatnonzero(hi > lo)
    if not len(found):
        return n_words, n_hit, items, spans
    count = hi[found] - lo[found]
    first = word[index.locate(ragged(lo[found], count))]
    phrase = np.repeat(found, count)
    cover = np.zeros(len(sym) + 1, np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, first + block.length[phrase], -1)
    hit = np.cumsum(cover)[:-1] > 0
    n_hit = np.bincount(row[hit], minlength=rows)
    opens = hit.copy()
    opens[1:] &= ~(hit[:-1] & (row[1:] == row[:-1]))
    closes = hit.copy()
    closes[:-1] &= ~(hit[1:] & (row[1:] == row[:-1]))
    of_row = np.searchsorted(row, np.arange(rows))
    for s, e in zip(np.flatnonzero(opens), np.flatnonzero(closes)):
        r = row[s]
        spans[r].append(tuple(int(x) for x in (s - of_row[r], e - of_row[r], starts[s] - off[r], ends[e] - off[r])))
    pair = np.unique(row[first] * len(block.length) + phrase)
    for r, p in zip((pair // len(block.length)).tolist(), (pair % len(block.length)).tolist()):
        items[r].extend(block.items[block.item_start[p]:block.item_start[p + 1]])
    return n_words, n_hit, [sorted({i for i in x if isinstance(i, str)}) for x in items], spans


_SPAN = "array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>"
_HITS = f"doc_id long, n_words long, n_hit long, items array<string>, spans {_SPAN}, mark long"


def _search(windows: list[str], names: list[str]):
    def shard(batches):
        block = Windows(windows, names)
        names_ = ("first", "last", "start", "end")
        span = pa.list_(pa.struct([(x, pa.int64()) for x in names_]))
        for batch in batches:
            for part in slices(batch, "text"):
                data, off = utf8(part.column(1))
                low = lower_ascii(data)
                n_words, n_hit, items, spans = find(block, low, off)
                marks = span_hash(prefix_hash(data), off[:-1], off[1:])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                     pa.array(items, pa.list_(pa.string())),
                     pa.array([[dict(zip(names_, y)) for y in x] for x in spans], span),
                     pa.array(marks.astype(np.int64))],
                    names=["doc_id", "n_words", "n_hit", "items", "spans", "mark"])
    return shard


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every (window, item_id), windows as words joined by one space."""
    words = F.regexp_extract_all(F.translate(F.col("text").cast("string"), UPPER, LOWER), F.lit(WORD), F.lit(1))
    return (benchmark.select(F.col("item_id").cast("string").alias("item_id"), words.alias("w"))
            .where(F.size("w") > 0)
            .select("item_id", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))).alias("k"))
            .select(F.array_join(F.slice("w", F.col("k") + 1, window), " ").alias("window"), "item_id"))


_MERGED = f"doc_id long, n_words long, n_hit long, items array<string>, spans {_SPAN}"


def _merge(batches):
    """Union of the word spans that several blocks found in one text, once per row that has the text."""
    for batch in batches:
        rows = []
        for doc_id, n_words, copies, items, spans in zip(*[c.to_pylist() for c in batch.columns]):
            out = []
            for x in sorted(spans, key=lambda x: (x["first"], x["last"])):
                if out and out[-1]["last"] + 1 >= x["first"]:
                    if x["last"] > out[-1]["last"]:
                        out[-1] |= {"last": x["last"], "end": x["end"]}
                else:
                    out.append(dict(x))
            hit = sum(x["last"] - x["first"] + 1 for x in out)
            rows += [(doc_id, n_words, hit, items, out)] * copies
        if rows:
            span = batch.schema.field("spans").type
            kinds = [pa.int64()] * 3 + [pa.list_(pa.string()), span]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             names=["doc_id", "n_words", "n_hit", "items", "spans"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW,
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items, spans (words and bytes to remove)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    windows = stored(item_windows(benchmark, window), "windows")
    blocks = max(1, -(-windows.count() // block_windows))
    if blocks == 1:
        rows = windows.collect()
        return docs.mapInArrow(_search([r[0] for r in rows], [r[1] for r in rows]), _HITS).drop("mark")
    hits = None
    for b in range(blocks):
        rows = windows.where(F.pmod(F.xxhash64("window", "item_id"), F.lit(blocks)) == b).collect()
        one = docs.mapInArrow(_search([r[0] for r in rows], [r[1] for r in rows]), _HITS)
        hits = one if hits is None else hits.unionByName(one)
    # the blocks' answers to one text meet; rows that repeat it are given back after
    merged = hits.groupBy("doc_id", "mark").agg(
        F.max("n_words").alias("n_words"), (F.count("*") / blocks).cast("int").alias("copies"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"))
    return merged.select("doc_id", "n_words", "copies", "items", "spans").mapInArrow(_merge, _MERGED)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def report(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
with lowered as (
  select 'd' as kind, doc_id as id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
  union all
  select 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') from benchmark),
words as (select kind, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from lowered),
windows as (
  select id as item_id, least(len(w), 10) as size, array_to_string(w[k:k + 9], ' ') as win
  from words, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as r(k) where kind = 'b' and len(w) > 0),
sizes as (select distinct size from windows),
places as (
  select id as doc_id, size, k, array_to_string(w[k:k + size - 1], ' ') as win
  from words, sizes, unnest(range(1, len(w) - size + 2)) as r(k) where kind = 'd' and len(w) >= size),
hits as (select distinct p.doc_id, p.k, p.size, x.item_id from places p join windows x on p.win = x.win and p.size = x.size),
hit_words as (select doc_id, count(distinct u) as n_hit from hits, unnest(range(k, k + size)) as r(u) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list
  from (select distinct doc_id, cast(item_id as varchar) as item from hits where item_id is not null) group by doc_id)
select d.id as doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(h.n_hit, 0) as bigint) as n_hit,
       cast(coalesce(i.n_items, 0) as bigint) as n_items, sha256(coalesce(i.list, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 as contaminated
from words d left join hit_words h on d.id = h.doc_id left join items i on d.id = i.doc_id
where d.kind = 'd'
"""
