"""Token-id output in byte or bit planes.

Documents are range-partitioned by doc_id; each task tokenizes its range in
order and writes one shard file.  A shard file holds fixed-size blocks of ids.
A block is transposed into planes (the k-th byte, or the k-th bit, of every
id), each plane compressed on its own, so the planes that hardly change cost
next to nothing.  The chunk index at the end of the file has the id count of
each block, offset and size of each plane, and each document's id and length,
so any document can be read from the blocks it lies in.

File: ``TIDP`` | planes ... | index (zstd of JSON) | index offset, index size
(little-endian 64-bit) | ``TIDP``.

Each attempt of a task writes a file of its own name; only the files named in
the manifest, which Spark commits, count, so a lost executor leaves no wrong
data.  The folder is the shared one of ``spark.checkpoint.dir`` unless given.

Words recur, so a worker keeps the ids of words it has seen; Arrow splits a
slice of texts and numbers its distinct words, so Python sees each of them once.  Splitting a text
at spaces and newlines is exact for the tokenizer used here: its first step
turns white space into single spaces that belong to no token.

Defined results: null text is empty and gets the end id only; null doc_ids
come first; rows that repeat a doc_id, or have none, stand next to each other,
ordered by a hash of the text, and may fill several shards; an empty table writes
no shard; extra columns are not read.
"""

from __future__ import annotations

import itertools
import json
import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Ragged, documents, shared_dir, shuffle_width, slices, stored

MAGIC = b"TIDP"
BLOCK_IDS = 1 << 16
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
# words a worker remembers; it starts anew beyond
CACHE_WORDS = 500_000
TAIL = ".,;:!?|%&$#*"
JOINED = 2000         # words tokenized in one string


class _Encoder:
    """Ids of texts, word by word, with a bounded memory of words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.pieces: dict[str, list[int]] = {}
        self.known = Ragged()

    def _piece(self, text: str, letters: bool) -> list[int]:
        found = self.pieces.get(text)
        if found is None:
            found = self.pieces[text] = [t.id for t in self.model.tokenize(text)] if letters else self.tokenizer.encode(
                text, add_special_tokens=False).ids
        return found

    def _learn(self, words: list[str]) -> None:
        """ASCII letters with plain punctuation behind are two pieces to the tokenizer and
        need no normalizer.  All other words take the whole way, joined by spaces again;
        the place of a token tells its word."""
        ids, odd = [None] * len(words), []
        for k, word in enumerate(words):
            letters = word.rstrip(TAIL)
            if letters.isascii() and letters.isalpha():
                mine = self._piece(letters.lower(), True)
                ids[k] = mine if len(letters) == len(word) else mine + self._piece(word[len(letters):], False)
            else:
                odd.append(k)
        for lo in range(0, len(odd), JOINED):
            some = odd[lo:lo + JOINED]
            coded = self.tokenizer.encode(" ".join([words[k] for k in some]), add_special_tokens=False)
            starts = np.cumsum([0] + [len(words[k]) + 1 for k in some])
            ends = np.searchsorted(np.array([o[0] for o in coded.offsets], np.int64), starts[1:]).tolist()
            found = coded.ids
            for k, a, b in zip(some, [0, *ends], ends):
                ids[k] = found[a:b]
        self.known.extend(np.fromiter(itertools.chain.from_iterable(ids), np.int32), np.array([len(x) for x in ids], np.int64))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        if len(self.number) > CACHE_WORDS:
            self.clear()
        number, known = self.number, len(self.number)
        split = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "), " ")
        coded = pc.list_flatten(split).dictionary_encode()
        place = np.array([number.setdefault(w, len(number)) for w in coded.dictionary.to_pylist()], np.int64)
        if len(number) > known:
            self._learn(list(itertools.islice(reversed(number), len(number) - known))[::-1])
        ids, size = self.known.take(place[coded.indices.to_numpy()])
        ends = np.append(0, np.cumsum(size))
        return ids.astype(np.uint32), np.diff(ends[split.offsets.to_numpy()])


_ENCODERS: dict[str, _Encoder] = {}


def encoder(path: str) -> _Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if planes == "bit":
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        return [x.tobytes() for x in np.packbits(bits.T, axis=1)]
    return [np.ascontiguousarray(x).tobytes() for x in raw.T]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    rows = np.stack([np.frombuffer(x, np.uint8) for x in planes])
    if kind == "bit":
        bits = np.unpackbits(rows, axis=1, count=n)
        raw = np.packbits(bits.T, axis=1, bitorder="little")
    else:
        raw = rows.T
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


class ShardWriter:
    def __init__(self, stream, planes: str = "byte", block_ids: int = BLOCK_IDS):
        self.stream, self.kind, self.block = stream, planes, block_ids
        self.pending, self.waiting, self.at = [], 0, len(MAGIC)
        self.blocks, self.doc_ids, self.sizes = [], [], []
        self.zstd = zstandard.ZstdCompressor(level=3)
        stream.write(MAGIC)

    def add(self, doc_ids: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.sizes += sizes.tolist()
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, np.uint32)
        whole = len(ids) if last else len(ids) - len(ids) % self.block
        for lo in range(0, whole, self.block):
            part = ids[lo:min(lo + self.block, whole)]
            chunk = []
            for plane in to_planes(part, self.kind):
                data = self.zstd.compress(plane)
                self.stream.write(data)
                chunk.append([self.at, len(data)])
                self.at += len(data)
            self.blocks.append([len(part), chunk])
        self.pending, self.waiting = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        index = self.zstd.compress(json.dumps({
            "planes": self.kind, "blocks": self.blocks, "doc_ids": self.doc_ids, "sizes": self.sizes}).encode())
        self.stream.write(index)
        self.stream.write(struct.pack("<QQ", self.at, len(index)) + MAGIC)
        self.stream.close()


class ShardReader:
    def __init__(self, file):
        self.file = file
        end = file.size()
        at, size = struct.unpack("<QQ", file.read_at(16, end - 20))
        assert file.read_at(4, end - 4) == MAGIC, "not a shard file"
        self.zstd = zstandard.ZstdDecompressor()
        self.index = json.loads(self.zstd.decompress(file.read_at(size, at)))

    def blocks(self):
        for n, chunk in self.index["blocks"]:
            planes = [self.zstd.decompress(self.file.read_at(size, at)) for at, size in chunk]
            yield from_planes(planes, n, self.index["planes"])

    def documents(self):
        """(doc_id, ids) in file order."""
        rest, blocks = np.zeros(0, np.uint32), self.blocks()
        for doc_id, size in zip(self.index["doc_ids"], self.index["sizes"]):
            parts = [rest]
            have = len(rest)
            while have < size:
                parts.append(next(blocks))
                have += len(parts[-1])
            ids = np.concatenate(parts) if len(parts) > 1 else rest
            rest = ids[size:]
            yield doc_id, ids[:size]


def _open(uri: str):
    system, path = pafs.FileSystem.from_uri(uri)
    return system, path


_MANIFEST = "file string, part int, n_docs long, n_ids long"


def _write(folder: str, tokenizer: str, planes: str):
    def shard(batches):
        writer, n_ids, name = None, 0, f"{folder}/{uuid.uuid4().hex}.ids"
        code = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                ids, sizes = code.encode(pc.fill_null(part.column(1), ""))
                ends = np.cumsum(sizes)
                ids = np.insert(ids, ends, END_ID)
                if writer is None:
                    system, path = _open(name)
                    writer = ShardWriter(system.open_output_stream(path), planes)
                writer.add(part.column(0).to_pylist(), ids, sizes + 1)
                n_ids += len(ids)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([TaskContext.get().partitionId()], pa.int32()),
                 pa.array([len(writer.doc_ids)], pa.int64()), pa.array([n_ids], pa.int64())],
                names=["file", "part", "n_docs", "n_ids"])
    return shard


def write_ids(docs: DataFrame, *, tokenizer: str, folder: str | None = None, planes: str = "byte") -> DataFrame:
    """Write all documents' ids in ascending doc_id order; returns the manifest."""
    spark = docs.sparkSession
    folder = folder or shared_dir(spark, "ids")
    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    # an id that very many rows share is spread by their texts
    order = ["doc_id", F.xxhash64("text")]
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order))
    return stored(ordered.mapInArrow(_write(folder, tokenizer, planes), _MANIFEST), "manifest")


def _read(batches):
    for batch in batches:
        for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            system, path = _open(file)
            with system.open_input_file(path) as f:
                out = []
                for doc_id, ids in ShardReader(f).documents():
                    out.append((doc_id, base, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    base += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_back(manifest: DataFrame) -> DataFrame:
    """Per document: start, n_tokens and checksum, from the files alone."""
    # one row per shard file; shards follow their partitions, which are ranges of ids
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.select("file", F.coalesce(before, F.lit(0)).alias("base"))
    return (shards.repartition(shuffle_width(manifest.sparkSession))
            .mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def op4_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    manifest = write_ids(documents(spark, sf_dir), tokenizer=str(public_tokenizers.path(TOKENIZER)))
    return read_back(manifest)
