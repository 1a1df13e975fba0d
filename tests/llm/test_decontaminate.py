import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import ODD, SF, empty_documents, odd_documents, table, words
from tidemark.llm import decontaminate as D


def expected(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (x := tuple(w[k:k + size])) in windows:
                    found |= windows[x]
                    hit.update(range(k, k + size))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, D.report(df).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


ITEMS = [(1, "one"), (2, "words and more of"), (3, None), (4, "..."), (5, "word " * 25), (6, "ONE"),
         (7, "text here five words and more of them same text here"), (7, "one")]


def test_odd_rows_and_blocks(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = expected(ODD, ITEMS)
    assert found(D.decontaminate(odd_documents(spark), items)) == want
    assert found(D.decontaminate(odd_documents(spark), items, block_windows=2)) == want
    assert found(D.decontaminate(odd_documents(spark), items.where("false"))) == expected(ODD, [])
    assert found(D.decontaminate(empty_documents(spark), items)) == []


def test_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(SF, "documents")]
    items = [(r["item_id"], r["text"]) for r in table(SF, "benchmark")]
    df = D.decontaminate(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet"))
    got = found(df)
    assert got == expected(docs, items) and any(r[5] for r in got)


def test_spans_cover_the_hit_words(spark):
    docs = odd_documents(spark, [(1, "Ümlaut one, ONE two")])
    row = D.decontaminate(docs, spark.createDataFrame([(1, "one")], "item_id long, text string")).first()
    raw = "Ümlaut one, ONE two".encode()
    assert [raw[s["start"]:s["end"]] for s in row["spans"]] == [b"one, ONE"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=80), st.lists(st.integers(1, 4), min_size=1, max_size=4))
def test_fm_index_finds_all(text, phrase):
    index = D.FMIndex(np.array(text + [0]), 5)
    lo, hi = index.search(np.array([phrase]), np.array([len(phrase)]))
    at = sorted(index.locate(np.arange(lo[0], hi[0])).tolist()) if hi[0] > lo[0] else []
    assert at == [k for k in range(len(text) - len(phrase) + 1) if text[k:k + len(phrase)] == phrase]


def test_items_without_an_id(spark):
    """Their windows are hits; they are not counted or named as items."""
    items = spark.createDataFrame([(None, "one two three"), (4, "one two three"), (None, "only here")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "zero one two three four"), (2, "only here"), (3, "nothing")], "doc_id long, text string")
    for blocks in (100_000, 1):
        got = {r.doc_id: (r.n_hit, r.items) for r in D.decontaminate(docs, items, block_windows=blocks).collect()}
        assert got == {1: (3, ["4"]), 2: (2, []), 3: (0, [])}
