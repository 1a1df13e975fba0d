"""Best-fit packing into bins of several permitted lengths.

Items of equal length are interchangeable, so the packing is decided on the
histogram of lengths, which has at most ``max(capacities)`` rows however many
documents there are.  Best-fit decreasing runs over the histogram: each length
goes into the open bins with the least room that still fits, whole runs of
equal bins at a time.  Where no open bin fits, the permitted sizes compete: for
each size the room beside the item is filled ahead with the lengths still to
come, and the size with the least cost per token filled is opened.  At the end
each bin is downsized to the shortest permitted length that holds its contents.

The result of that step is a list of runs "items a..b of length L go to bins
c..d at this offset", whose number depends on the capacities and not on the
data.  Documents then find their place by their rank among items of their
length.  Ranks are counted in salted slots, so a length that a third of all
documents share is spread over all tasks.

A document longer than the largest capacity is cut into pieces; nothing is
dropped or shortened.

Lengths are token counts of a sentence-piece model over whole texts, and an end
token.  Any other count column can be packed.

Defined results: null and empty texts count as the end token alone; repeated
rows are packed each; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_CUT, documents, shuffle_width, slices, stored

TOKENIZER = "piece_bpe_32k.model"
PART_CHARS = 1 << 16        # longer texts reach the tokenizer in parts
CAPACITIES = (1024, 2048, 4096, 8192)
# a sequence of c tokens costs c plus its attention, c^2 over this many tokens
ATTENTION = 1 << 16


def cost(capacity: int) -> float:
    return capacity + capacity * capacity / ATTENTION


class Plan:
    """Best-fit decreasing over {length: count}; see the module text.

    places: (length, first rank, items, first bin, offset); bins: (first bin,
    bins, size, tokens) in order of the first bin."""

    def __init__(self, histogram: dict[int, int], capacities=CAPACITIES, cost=cost):
        self.capacities, self.cost = sorted(capacities), cost
        self.places: list[tuple] = []
        self.bins: list[tuple] = []
        self.made = 0
        self.rooms: list[int] = []                    # rooms of open bins, ascending
        self.open: dict[int, list[tuple]] = {}        # room -> runs (first bin, bins, capacity)
        self.supply = dict(histogram)                 # items that no opening has counted on yet
        self.lengths = sorted(histogram)
        for length in sorted(histogram, reverse=True):
            self._place(length, histogram[length])
        for room, runs in self.open.items():
            self.bins += [(first, n, capacity - room) for first, n, capacity in runs]
        self.bins = sorted((first, n, self._least(used), used) for first, n, used in self.bins)

    def _least(self, tokens: int) -> int:
        return self.capacities[bisect_left(self.capacities, tokens)]

    def _add(self, room: int, run: tuple) -> None:
        if room not in self.open:
            self.open[room] = []
            insort(self.rooms, room)
        self.open[room].append(run)

    def _place(self, length: int, count: int) -> None:
        rank = 0
        while rank < count:
            k = bisect_left(self.rooms, length)
            if k == len(self.rooms):
                capacity, bins = self._choose(length, count - rank)
                self._add(capacity, (self.made, bins, capacity))
                self.made += bins
                continue
            room = self.rooms[k]
            first, bins, capacity = self.open[room].pop()
            if not self.open[room]:
                del self.open[room]
                self.rooms.pop(k)
            n = min(bins, count - rank)
            if n < bins:
                self._add(room, (first + n, bins - n, capacity))
            self.places.append((length, rank, n, first, capacity - room))
            self._add(room - length, (first, n, capacity))
            rank += n

    def _choose(self, length: int, need: int) -> tuple[int, int]:
        """The size with the least cost per token it can be filled with, and how
        many bins can be filled that way."""
        best = None
        for capacity in self.capacities[bisect_left(self.capacities, length):]:
            used, room = {length: 1}, capacity - length
            top = length
            while room and (k := bisect_right(self.lengths, min(room, top))):
                top = self.lengths[k - 1]
                free = self.supply.get(top, 0) - used.get(top, 0)
                if free <= 0:
                    top -= 1
                    if not top:
                        break
                    continue
                n = min(free, room // top)
                used[top] = used.get(top, 0) + n
                room -= n * top
                top = min(top, room)
                if not top:
                    break
            price = self.cost(capacity) / (capacity - room)
            if best is None or price < best[0]:
                best = price, capacity, used
        _, capacity, used = best
        bins = min([need] + [self.supply.get(x, 0) // n for x, n in used.items()])
        bins = max(1, bins)
        for x, n in used.items():
            self.supply[x] = max(0, self.supply.get(x, 0) - n * bins)
        # lengths without supply left are skipped from now on
        gone = [x for x in used if not self.supply[x]]
        for x in gone:
            k = bisect_left(self.lengths, x)
            if k < len(self.lengths) and self.lengths[k] == x:
                self.lengths.pop(k)
        return capacity, bins


_PACKED = "doc_id long, piece long, start long, n_tokens long, bin_id long, bin_offset long, bin_size long"


def _seat(plan: Plan):
    places = np.array(sorted(plan.places), np.int64).reshape(-1, 5)
    bins = np.array(plan.bins, np.int64).reshape(-1, 4)
    largest = int(places[:, 1].max(initial=0)) + 1

    def seat(batches):
        key = places[:, 0] * largest + places[:, 1]
        for batch in batches:
            rank = batch.column(4).to_numpy()
            length = batch.column(3).to_numpy()
            # ranks beyond the largest first rank belong to the length's last run
            at = np.searchsorted(key, length * largest + np.minimum(rank, largest - 1), side="right") - 1
            bin_id = places[at, 3] + rank - places[at, 1]
            size = bins[np.searchsorted(bins[:, 0], bin_id, side="right") - 1, 2]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:4] + [pa.array(bin_id), pa.array(places[at, 4]), pa.array(size)],
                names=["doc_id", "piece", "start", "n_tokens", "bin_id", "bin_offset", "bin_size"])
    return seat


def pack(lengths: DataFrame, *, capacities=CAPACITIES, cost=cost) -> DataFrame:
    """Pack rows of (doc_id, n_tokens); one row per piece with its bin.

    A length that is null or below 1 counts as 1."""
    spark = lengths.sparkSession
    top, slots = max(capacities), shuffle_width(spark)
    n = F.greatest(F.col("n_tokens").cast("long"), F.lit(1).cast("long"))
    items = stored(
        lengths.select(F.col("doc_id").cast("long").alias("doc_id"), n.alias("total"),
                       # rows alike in every column part ways here; the id is stored with the row
                F.monotonically_increasing_id().alias("salt"))
        .select("doc_id", "total", "salt",
                F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / top))).alias("piece"))
        .select("doc_id", "piece", (F.col("piece") * top).alias("start"),
                F.least(F.col("total") - F.col("piece") * top, F.lit(top)).alias("n_tokens"),
                F.pmod(F.xxhash64("salt", "piece"), F.lit(slots)).alias("slot")), "items")
    counts = items.groupBy("n_tokens", "slot").agg(F.count("*").alias("n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("n_tokens").agg(F.sum("n")).collect()}   # <= top rows
    plan = Plan(histogram, capacities, cost)
    before = F.sum("n").over(Window.partitionBy("n_tokens").orderBy("slot")
                             .rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select(F.col("n_tokens"), F.col("slot"), F.coalesce(before, F.lit(0)).alias("base"))
    seq = F.row_number().over(Window.partitionBy("n_tokens", "slot").orderBy("doc_id", "piece"))
    ranked = (items.withColumn("seq", seq).join(base, ["n_tokens", "slot"])
              .select("doc_id", "piece", "start", "n_tokens", (F.col("base") + F.col("seq") - 1).alias("rank")))
    return ranked.mapInArrow(_seat(plan), _PACKED)


_MODELS: dict[str, object] = {}


def _parts(text: str) -> list[str]:
    """A long text in parts, cut at spaces between words, which are left out."""
    out, at = [], 0
    while len(text) - at > PART_CHARS and (cut := WORD_CUT.search(text, at + PART_CHARS)):
        out.append(text[at:cut.start()])
        at = cut.end()
    return [*out, text[at:]]


def _tokens(path: str):
    def count(batches):
        import sentencepiece
        if path not in _MODELS:
            _MODELS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                parts = [_parts(t) for t in pc.fill_null(part.column(1), "").to_pylist()]
                size = [len(x) for x in _MODELS[path].encode([p for ps in parts for p in ps], num_threads=1)]
                ends = np.cumsum([0, *size])[np.cumsum([0, *map(len, parts)])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(ends) + 1, pa.int64())],
                                                 names=["doc_id", "n_tokens"])
    return count


def token_lengths(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Tokens of each whole text by a sentence-piece model, and the end token."""
    if tokenizer is None:
        import public_tokenizers
        tokenizer = str(public_tokenizers.path(TOKENIZER))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_tokens(tokenizer), "doc_id long, n_tokens long")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_lengths(documents(spark, sf_dir)))
