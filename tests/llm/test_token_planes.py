import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs
from tokenizers import Tokenizer

from tests.llm.cases import ODD, SF, empty_documents, odd_documents, table
from tidemark.llm import token_planes as T

PATH = str(public_tokenizers.path(T.TOKENIZER))
REAL = Tokenizer.from_file(PATH)


def ids_of(text):
    return REAL.encode(text or "", add_special_tokens=False).ids


def check(df, rows):
    """Ids of every row, in ascending doc_id order without gaps (rows of one id in any order)."""
    got = sorted(map(tuple, df.select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    want = []
    for doc_id, text in rows:
        ids = ids_of(text) + [1]
        want.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((r[1:] for r in got), key=str) == sorted(want, key=str)
    assert [r[0] for r in got] == [sum(r[2] for r in got[:k]) for k in range(len(got))]
    order = [(r[1] is not None, r[1] or 0) for r in got]
    assert order == sorted(order)


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_odd_rows(spark, planes):
    manifest = T.write_ids(odd_documents(spark), tokenizer=PATH, planes=planes)
    check(T.read_back(manifest), ODD)


def test_empty_and_whole_table(spark):
    check(T.read_back(T.write_ids(empty_documents(spark), tokenizer=PATH)), [])
    check(T.op4_token_planes(spark, SF), [(r["doc_id"], r["text"]) for r in table(SF, "documents")])


def test_an_id_of_many_rows_fills_several_shards(spark):
    rows = [(None if k % 3 else 7, f"text number {k}") for k in range(3000)] + [(k, "one") for k in range(20)]
    manifest = T.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer=PATH)
    assert manifest.agg({"n_docs": "max"}).first()[0] < 1500
    check(T.read_back(manifest), rows)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abzAZ'é́ſK ..,!?%0١\n\t\xa0\x85<|>İΣς😀")), max_size=40),
       st.sampled_from(["", "<|endoftext|>", "it's we'll", "a,b.c...", " \n "]))
def test_words_are_tokenized_as_in_the_text(text, more):
    code = T.encoder(PATH)
    got, sizes = code.encode(pa.array([text + more, more + text]))
    assert got.tolist() == ids_of(text + more) + ids_of(more + text) and sizes.sum() == len(got)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, (1 << 32) - 1), min_size=1, max_size=50), st.sampled_from(["bit", "byte"]))
def test_planes_round_trip(ids, kind):
    ids = np.array(ids, np.uint32)
    assert (T.from_planes(T.to_planes(ids, kind), len(ids), kind) == ids).all()


def test_documents_across_blocks(tmp_path):
    path = str(tmp_path / "x.ids")
    local = fs.LocalFileSystem()
    writer = T.ShardWriter(local.open_output_stream(path), "byte", block_ids=16)
    sizes = [0, 1, 15, 16, 17, 100, 0, 3]
    data = [np.arange(n, dtype=np.uint32) + 70_000 * k for k, n in enumerate(sizes)]
    for k, ids in enumerate(data):
        writer.add([k], ids, np.array([len(ids)]))
    writer.close()
    with local.open_input_file(path) as f:
        got = list(T.ShardReader(f).documents())
    assert [d for d, _ in got] == list(range(8)) and all((a == b).all() for (_, a), b in zip(got, data))
