"""Alignment of the tokens of two tokenizers.

Both tokenizers cut the same bytes (a space and the text).  A *link* is a pair
of token occurrences whose bytes overlap; a *group* is a stretch between two
places where tokens of both end.  Pairs of ids are weighed by the number of
documents of the whole corpus that hold them linked.

The work inside a task is Arrow from end to end.  Id lists are flattened with
their parent indices; a segmented cumulative sum of token lengths gives the byte
end of each token in its document; an Acero full outer hash join of both token
tables on (document, end) leaves one row per end of either side, and between two
neighbouring ends exactly one token of each side lies, so these rows are the
links and the rows with both sides are the ends of groups.  ``Table.group_by``
counts what each document and each block of documents holds.

Documents stay in blocks of a few megabytes of text, one stored row each, with
the distinct id pairs of the block once.  Spark merges the partial counts of all
blocks (a pair is one row per block, however many documents hold it), finds the
best partner of every id, and joins the counts back to the blocks, where they
are spread over the documents by position.

Texts are cut for the tokenizers at every single space between two visible
characters: one tokenizer starts a new piece there, the other has no entry with
a space behind a character, so the ids are those of the whole text.  A worker
remembers the ids of the units between cuts, and new units are tokenized joined
by spaces again; the byte ends of the tokens tell the units' ids apart.

Defined results: a null or empty text, and one whose tokens do not spell it
byte for byte, has no tokens: zeros and an empty group string.  A row is a
document, also one without an id or with the id of another.  An empty table
gives an empty result; extra columns are not read.  Memory grows with the
longest single text, some 150 bytes a byte.
"""

from __future__ import annotations

import hashlib
import itertools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import EDGE, WORD_CUT, Ragged, documents, slices, stored

BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 4 << 20       # text in one block
STEP_BYTES = 512 << 10      # text that is tokenized and joined at a time
JOIN_CHARS = 1 << 15        # new units reach the tokenizers in strings of about this length
CACHE_UNITS = 400_000       # units that a worker remembers; it starts anew beyond
_SPACE = "▁"


def _byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level entries."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Pair:
    """Two tokenizers and the bytes of their entries."""

    def __init__(self, byte_file: str, piece_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.first = Tokenizer.from_file(byte_file)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        alphabet = _byte_alphabet()
        entry = [b""] * self.first.get_vocab_size()
        for token, k in self.first.get_vocab().items():
            entry[k] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        pieces = [self.second.id_to_piece(k) for k in range(self.second.get_piece_size())]
        self.entries = [pa.array(entry, pa.large_binary()), pa.array(
            [bytes([int(p[1:-1], 16)]) if self.second.is_byte(k) else p.replace(_SPACE, " ").encode()
             for k, p in enumerate(pieces)], pa.large_binary())]
        self.sizes = [pc.binary_length(e).cast(pa.int64()) for e in self.entries]
        self.names = [pa.array([str(k) for k in range(len(e))], pa.large_string()) for e in self.entries]
        self.cuts = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.units = [Ragged(), Ragged()]

    def _ids(self, side: int, strings: list[str]) -> list[list[int]]:
        if side:
            return self.second.encode(strings, num_threads=1)
        return [e.ids for e in self.first.encode_batch_fast([" " + x for x in strings], add_special_tokens=False)]

    def _learn(self, units: list[str]) -> None:
        joined, some, size = [], [], 0
        for u in units:
            # a unit from the start or end of a text may begin or end in white space
            inner = EDGE.match(u[0]) and EDGE.match(u[-1])
            if some and (size >= JOIN_CHARS or not inner):
                joined.append(" ".join(some))
                some, size = [], 0
            if inner:
                some.append(u)
                size += len(u) + 1
            else:
                joined.append(u)
        if some:
            joined.append(" ".join(some))
        want = np.cumsum([len(u.encode()) + 1 for u in units])
        for side, known in enumerate(self.units):
            ids = np.fromiter(itertools.chain.from_iterable(self._ids(side, joined)), np.int32)
            ends = np.cumsum(self.sizes[side].to_numpy()[ids])
            at = np.searchsorted(ends, want)
            if len(ends) and ends[-1] == want[-1] and (ends[at] == want).all():
                known.extend(ids, np.diff(at + 1, prepend=0))
            else:       # a unit that its tokens do not spell: each by itself
                each = self._ids(side, units)
                known.extend(np.fromiter(itertools.chain.from_iterable(each), np.int32), np.array([len(x) for x in each]))

    def encode(self, texts: list[str]) -> list[pa.LargeListArray]:
        """Id lists of both tokenizers; an empty text has none."""
        if len(self.number) > CACHE_UNITS:
            self.forget()
        number, known = self.number, len(self.number)
        units, counts = [], []
        for text in texts:
            split = (WORD_CUT.split(text) if self.cuts else [text]) if text else []
            units += [number.setdefault(u, len(number)) for u in split]
            counts.append(len(split))
        if len(number) > known:
            new = list(itertools.islice(reversed(number), len(number) - known))
            self._learn(new[::-1])
        units, bounds = np.array(units, np.int64), np.cumsum([0, *counts])
        out = []
        for have in self.units:
            ids, size = have.take(units)
            ends = np.append(0, np.cumsum(size))
            out.append(pa.LargeListArray.from_arrays(pa.array(ends[bounds], pa.int64()), pa.array(ids)))
        return out


_PAIRS: dict[tuple, Pair] = {}


def pair_of(*files: str) -> Pair:
    if files not in _PAIRS:
        _PAIRS[files] = Pair(*files)
    return _PAIRS[files]


def _data(column: pa.Array) -> np.ndarray:
    """The bytes of a large_binary or large_string column without nulls, one row after another."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0]:ends[-1]]


def _ends(lists: pa.LargeListArray, sizes: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """(document of each token, byte end of each token in its document, bytes of each document)."""
    doc = pc.list_parent_indices(lists)
    flat = pc.list_flatten(lists)
    run = pc.cumulative_sum(sizes.take(flat))
    run = np.append(0, run.to_numpy())
    offsets = lists.offsets.to_numpy()
    base = run[offsets - offsets[0]]
    end = pa.array(run[1:]) if not len(flat) else pc.subtract(pa.array(run[1:]), pa.array(base[:-1]).take(doc))
    return doc, end, np.diff(base)


def _spelled(pair: Pair, texts: pa.Array, lists: list[pa.LargeListArray]) -> np.ndarray:
    """Which texts both id lists spell byte for byte."""
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ok = size > 0
    for side, ids in enumerate(lists):
        ok &= _ends(ids, pair.sizes[side])[2] == size + 1
    keep = pa.array(ok)
    want = _data(pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts.filter(keep),
                                             pa.scalar("", pa.large_string())))
    ends = np.cumsum(size[ok] + 1)
    for side, ids in enumerate(lists):
        got = _data(pair.entries[side].take(pc.list_flatten(ids.filter(keep))))
        wrong = np.searchsorted(ends, np.flatnonzero(got != want), side="right")
        ok[np.flatnonzero(ok)[np.unique(wrong)]] = False
        if len(wrong):
            return _spelled(pair, pc.if_else(pa.array(ok), texts, pa.scalar("", pa.large_string())), lists)
    return ok


def _per_doc(doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, minlength=n).astype(np.int64)


def align(pair: Pair, texts: pa.Array) -> tuple[pa.Table, pa.Table]:
    """Per text (n_a, n_b, n_groups, n_links, groups) and the distinct id pairs
    of each text (doc, a, b, occ).  ``groups`` is null without tokens."""
    n = len(texts)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pair.encode(texts.to_pylist())
    ok = _spelled(pair, texts, lists)
    # of the others, empty lists: positions of documents stay
    lists = [pc.if_else(pa.array(ok), x, pa.scalar([], x.type)) for x in lists]
    flat = [pc.list_flatten(x) for x in lists]
    sides = []
    for side, x in enumerate(lists):
        doc, end, _ = _ends(x, pair.sizes[side])
        at = pa.array(np.arange(len(doc)), pa.int64())
        sides.append(pa.table({"doc": doc.cast(pa.int64()), "end": end, "ab"[side]: at}))
    rows = (sides[0].join(sides[1], ["doc", "end"], join_type="full outer", use_threads=False)
            .sort_by([("doc", "ascending"), ("end", "ascending")]).combine_chunks())
    shared = rows.filter(pc.and_(rows["a"].is_valid(), rows["b"].is_valid()))
    # the token that holds the bytes before an end is the next one to end
    links = pa.table({"doc": rows["doc"], "a": flat[0].take(pc.fill_null_backward(rows["a"])),
                      "b": flat[1].take(pc.fill_null_backward(rows["b"]))})

    n_groups = _per_doc(shared["doc"].to_numpy(), n)
    strings = []
    for side, name in enumerate("ab"):
        offsets = pa.array(np.append(0, shared[name].to_numpy() + 1), pa.int64())
        ids = pa.LargeListArray.from_arrays(offsets, pair.names[side].take(flat[side]))
        strings.append(pc.binary_join(ids, pa.scalar(",", pa.large_string())))
    group = pc.binary_join_element_wise(*strings, pa.scalar("|", pa.large_string()))
    group = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_groups)), pa.int64()), group)
    groups = pc.if_else(pa.array(ok), pc.binary_join(group, pa.scalar(";", pa.large_string())), pa.scalar(None, pa.large_string()))
    sizes = [np.diff(x.offsets.to_numpy()) for x in lists]
    per_doc = pa.table({"n_a": sizes[0], "n_b": sizes[1], "n_groups": n_groups,
                        "n_links": _per_doc(links["doc"].to_numpy(), n), "groups": groups})
    held = links.group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(
        ["doc", "a", "b", "occ"])
    return per_doc, held


_BLOCK = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "sha array<string>, n_pairs array<int>, pair array<int>, occ array<int>, a array<int>, b array<int>, docs array<int>")


def _one(values, kind) -> pa.Array:
    """One row that holds a list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _block(number: int, ids: list, per_doc: list[pa.Table], held: list[pa.Table]) -> pa.RecordBatch:
    per_doc, held = pa.concat_tables(per_doc), pa.concat_tables(held)
    sha = [None if g is None else hashlib.sha256(g.encode()).hexdigest() for g in per_doc["groups"].to_pylist()]
    # each pair once, with the number of documents that hold it
    pairs = held.group_by(["a", "b"], use_threads=False).aggregate([("doc", "count")])
    pairs = pairs.append_column("pair", pa.array(np.arange(len(pairs)), pa.int32()))
    spread = held.join(pairs.select(["a", "b", "pair"]), ["a", "b"], join_type="inner", use_threads=False).sort_by("doc")
    columns = [pa.array([number]), _one(ids, pa.int64()),
               *[_one(per_doc[c].to_numpy(), pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
               _one([x or "" for x in sha], pa.string()), _one(_per_doc(spread["doc"].to_numpy(), len(ids)), pa.int32()),
               *[_one(spread[c].to_numpy(), pa.int32()) for c in ("pair", "occ")],
               *[_one(pairs[c].to_numpy(), pa.int32()) for c in ("a", "b", "doc_count")]]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _BLOCK.split(", ")])


def _blocks(files: tuple[str, str]):
    def run(batches):
        pair, number = pair_of(*files), TaskContext.get().partitionId() << 32
        ids, per_doc, held, size = [], [], [], 0
        for batch in batches:
            for part in slices(batch, "text", STEP_BYTES):
                one, some = align(pair, part.column(1))
                per_doc.append(one)
                held.append(some.set_column(0, "doc", pc.add(some["doc"], len(ids))))
                ids += part.column(0).to_pylist()
                size += part.column(1).nbytes
                if size >= BLOCK_BYTES:
                    yield _block(number, ids, per_doc, held)
                    ids, per_doc, held, size, number = [], [], [], 0, number + 1
        if ids:
            yield _block(number, ids, per_doc, held)
    return run


_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _finish(batches):
    """Counts of the pairs of a block, by position, spread over its documents."""
    for batch in batches:
        for row in range(len(batch)):
            one = {name: batch.column(k)[row].values for k, name in enumerate(batch.schema.names) if name != "block"}
            n = len(one["doc_id"])
            sums = np.zeros((2, n), np.int64)
            if len(one["pair"]):
                count, best = (np.zeros(len(one["place"]), np.int64) for _ in range(2))
                at = one["place"].to_numpy()
                count[at], best[at] = one["held_by"].to_numpy(), one["best"].to_numpy()
                pair, occ = one["pair"].to_numpy(), one["occ"].to_numpy().astype(np.int64)
                doc = pa.array(np.repeat(np.arange(n), one["n_pairs"].to_numpy()))
                total = pa.table({"doc": doc, "best": occ * best[pair], "sum": occ * count[pair]}).group_by(
                    "doc", use_threads=False).aggregate([("best", "sum"), ("sum", "sum")])
                sums[:, total["doc"].to_numpy()] = total["best_sum"].to_numpy(), total["sum_sum"].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [one["doc_id"], one["n_a"], one["n_b"], one["n_groups"], one["n_links"], pa.array(sums[0]), pa.array(sums[1]),
                 one["sha"]], names=[c.split()[0] for c in _RESULT.split(", ")])


def link_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, held_by, best): in how many documents two ids are linked, and whether
    no other partner of ``a`` is linked with it in more."""
    counts = (blocks.select(F.explode(F.arrays_zip("a", "b", "docs")).alias("p"))
              .groupBy("p.a", "p.b").agg(F.sum("p.docs").alias("held_by")))
    counts = stored(counts, "links")
    top = counts.groupBy("a").agg(F.max("held_by").alias("top"))
    return counts.join(top, "a").select("a", "b", "held_by", (F.col("held_by") == F.col("top")).cast("int").alias("best"))


def alignment(docs: DataFrame, *, byte_tokenizer: str, piece_tokenizer: str) -> DataFrame:
    """One row per document: tokens of either side, groups, links and their corpus-wide counts."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = stored(docs.mapInArrow(_blocks((byte_tokenizer, piece_tokenizer)), _BLOCK), "blocks")
    held = blocks.select("block", F.posexplode(F.arrays_zip("a", "b")).alias("place", "p")).select("block", "place", "p.a", "p.b")
    # at most the distinct pairs of one block come together again
    known = held.join(link_counts(blocks), ["a", "b"]).groupBy("block").agg(
        F.collect_list(F.struct("place", "held_by", "best")).alias("k"))
    whole = blocks.drop("a", "b", "docs").join(known, "block", "left")
    none = F.array().cast("array<long>")
    lists = [F.coalesce(F.col(f"k.{c}").cast("array<long>"), none).alias(c) for c in ("place", "held_by", "best")]
    return whole.select(*blocks.drop("a", "b", "docs").columns, *lists).mapInArrow(_finish, _RESULT)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return alignment(documents(spark, sf_dir), byte_tokenizer=str(public_tokenizers.path(BYTE_TOKENIZER)),
                     piece_tokenizer=str(public_tokenizers.path(PIECE_TOKENIZER)))
