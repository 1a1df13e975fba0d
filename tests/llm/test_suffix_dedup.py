import hashlib
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import ODD, SF, empty_documents, odd_documents, table
from tidemark.llm import gsaca
from tidemark.llm import suffix_dedup as D


def expected(rows, length=D.LENGTH):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k:k + length] for _, t in raw for k in range(len(t) - length + 1))
    out = []
    for doc_id, t in raw:
        cover = np.zeros(len(t) + 1, int)
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                cover[k] += 1
                cover[k + length] -= 1
        hit = np.concatenate(([0], np.cumsum(cover)[:-1] > 0, [0])).astype(int)
        kept = np.frombuffer(t, np.uint8)[hit[1:-1] == 0].tobytes()
        out.append((doc_id, len(t), int(hit.sum()), int((np.diff(hit) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_odd_rows(spark):
    rows = [(i, t[:4000] if t else t) for i, t in ODD]
    got = found(D.repeated_bytes(odd_documents(spark, rows)))
    assert got == expected(rows) and sum(r[2] for r in got) > 5000
    assert found(D.repeated_bytes(empty_documents(spark))) == []


def test_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(SF, "documents")]
    got = found(D.op1_suffix_dedup(spark, SF))
    assert got == expected(rows) and any(r[2] for r in got)


def test_passage_in_many_surroundings(spark):
    """One group of many classes, dealt again by finer ranges down to the ends."""
    rng = np.random.default_rng(5)
    letters = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    passage = letters(900)
    rows = [(k, letters(int(rng.integers(0, 600))) + passage[int(rng.integers(0, 200)):int(rng.integers(450, 900))]
             + letters(int(rng.integers(0, 600)))) for k in range(60)]
    rows += [(100, "xyz " * 400), (101, "yz x" * 300), (102, "a" * 1500), (103, "b" + "a" * 450), (103, passage)]
    rows += [(200, letters(500) + passage[100:700] + letters(500))] * 2 + [(None, passage[5:800])] * 2
    df = D.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string"), with_bytes=True)
    assert found(df) == expected(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in df.collect())


def test_long_documents_are_read_in_tiles(monkeypatch):
    import pyarrow as pa
    rng = np.random.default_rng(2)
    text = bytes(rng.integers(97, 123, 30_000).astype(np.uint8)).decode()
    batch = pa.RecordBatch.from_arrays([pa.array([5, 6], pa.int64()), pa.array([1, 2], pa.int64()), pa.array(["x", text])],
                                       names=["d1", "d2", "text"])
    windows = lambda: sorted((d, lo + k, an) for b in D._anchors(iter([batch]))
                             for d, lo, n, an in zip(*(b.column(c).to_pylist() for c in (2, 4, 5, 6))) for k in range(n))
    whole = windows()
    monkeypatch.setattr(D, "TILE", 4000)
    assert windows() == whole and [w[1] for w in whole] == list(range(30_000 - D.LENGTH + 1))


def test_equal_rows_cost_one_text(spark, monkeypatch):
    """Rows and spans stored on the way do not grow with the number of equal rows."""
    rng = np.random.default_rng(9)
    text = bytes(rng.integers(97, 123, 1900).astype(np.uint8)).decode()
    sizes, real = {}, D.stored

    def counting(df, name):
        out = real(df, name)
        sizes[n] = sizes.get(n, 0) + out.count()
        return out

    monkeypatch.setattr(D, "stored", counting)
    for n in (20, 2000):
        rows = [(None, text)] * n + [(1, text[300:900] + "!" * 100), (2, "nothing to see")]
        got = found(D.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string")))
        empty = hashlib.sha256(b"").hexdigest()
        assert Counter(got) == Counter({(None, 1900, 1900, 1, empty): n,
                                        (1, 700, 600, 1, hashlib.sha256(b"!" * 100).hexdigest()): 1,
                                        (2, 14, 0, 0, hashlib.sha256(b"nothing to see").hexdigest()): 1})
    assert sizes[2000] == sizes[20]


def test_bytes_decide_and_not_digests():
    """Two rows that share their digests by accident share only what their bytes share."""
    import pyarrow as pa
    rng = np.random.default_rng(1)
    letters = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    same, a, b, c = letters(450), letters(300), letters(300), letters(200)
    rows = [(1, 7, 351, a + same), (1, 7, 351, b + same), (2, 8, 101, c + same[:300]), (2, 8, 101, c + same[:300]), (3, 9, 1, letters(400))]
    batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows]) for k in range(4)], names=["h", "dg", "n", "bytes"])
    got = {(r["h"], r["dg"]): r["runs"] for out in D._repeats(iter([batch])) for r in out.to_pylist()}
    assert got == {(1, 7): [{"a": 300, "b": 350}], (2, 8): [{"a": 0, "b": 100}]}


def _moved(plan, column):
    """Exchanges of a plan that carry ``column``."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _moved(plan.initialPlan(), column)
    mine = "Exchange" in plan.nodeName() and f"{column}#" in plan.output().mkString(",")
    return int(mine) + sum(_moved(plan.children().apply(i), column) for i in range(plan.children().size()))


def test_texts_are_moved_once(spark, monkeypatch):
    """Texts go through one shuffle; runs, classes and spans come to them, also where no side is small."""
    rng = np.random.default_rng(4)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    shared = letters(900)
    rows = [(i, letters(300) + shared + letters(300)) for i in range(20)] + [(20, letters(800)), (21, shared), (22, shared), (23, None)]
    plans, keep = [], D.stored
    monkeypatch.setattr(D, "stored", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan()) or keep(df, name))
    monkeypatch.setattr(D, "CLASSES", 2)        # several rounds of finer runs
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = D.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string"))
        plans.append(out._jdf.queryExecution().executedPlan())
        got = found(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == expected(rows) and sum(r[2] >= 900 for r in got) == 22
    assert len(plans) > 8 and sum(_moved(p, "text") for p in plans) == 0
    assert spark.sql("SHOW TABLES LIKE 'llm_texts*'").count() == 0


texts = st.lists(st.lists(st.integers(1, 3), max_size=40), min_size=1, max_size=6)


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(1, 6))
def test_suffix_arrays(parts, length):
    parts = [p + [0] for p in parts]
    base = np.cumsum([0] + [len(p) for p in parts])
    symbols = np.array(sum(parts, []), np.uint16)
    order = gsaca.suffix_arrays(symbols, base)
    repeat = gsaca.repeated_windows(symbols, base, order, length, 4)
    for p, b in zip(parts, base):
        assert (order[b:b + len(p)] - b).tolist() == sorted(range(len(p)), key=lambda i: p[i:])
        for i in range(len(p) - length):
            assert repeat[b + i] == any(p[i:i + length] == p[j:j + length] for j in range(len(p) - length) if j != i)


@pytest.mark.parametrize("width", [1, 2, 7, 50])
def test_sliding_min(width):
    x = np.random.default_rng(1).integers(0, 99, 50).astype(np.uint64)
    assert D.sliding_min(x, width).tolist() == [x[k:k + width].min() for k in range(len(x) - width + 1)]


def _peak(run) -> int:
    """Most bytes of arrays and objects held at once by ``run``, beyond those held before."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_workers_hold_little_memory():
    """Two workers share an executor with its heap: reading a batch takes no more than some
    slices of it, the lockstep texts no more than some 50 bytes a symbol."""
    import pyarrow as pa
    rng = np.random.default_rng(8)
    letters = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    texts = [letters(2000).decode() for _ in range(4000)]
    ids = pa.array(range(4000), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], names=["d1", "d2", "text"])
    assert _peak(lambda: [None for _ in D._anchors(iter([batch]))]) < 60 << 20
    longest = pa.RecordBatch.from_arrays([ids[:1], ids[:1], pa.array([letters(3 << 20).decode()])], names=["d1", "d2", "text"])
    assert _peak(lambda: [None for _ in D._anchors(iter([longest]))]) < 120 << 20

    part = np.append(rng.integers(64, 320, 299), 0).astype(np.uint16)
    symbols, base = np.tile(part, 4000), np.arange(4001) * 300
    flags = []
    assert _peak(lambda: flags.append(gsaca.repeated_windows(symbols, base, gsaca.suffix_arrays(symbols, base), 100))) < 50 * len(symbols)
    assert not flags[0].any()
