import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.llm.cases import ODD, SF, empty_documents, lower, odd_documents, table
from tidemark.llm import merkle as M

H = lambda *x: sha256("".join(x).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """(root, [[(left, right) up the tree]])."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[k:k + 8]) for k in range(0, len(last), 8)])
    paths = []
    for k in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            lo = k // 8 * 8
            path.append(("".join(level[lo:k]), "".join(level[k + 1:lo + 8])))
            k //= 8
        paths.append(path)
    return levels[-1][0], paths


def brute(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups, roots = [], []
    for lang in langs:
        mine = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])), r["doc_id"],
                       leaf(r, r["text"] if r["text"] is None else lower(r["text"]))) for r in rows if r["lang"] == lang)
        subroot, paths = tree([m[0][2] for m in mine])
        roots.append(subroot)
        groups.append((mine, paths))
    root, above = tree(roots)
    out = []
    for (mine, paths), subroot, up in zip(groups, roots, above):
        for (key, doc_id, lowered), path in zip(mine, paths):
            hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
            value = lowered if hit else key[2]
            for a, b in path + up:
                value = H(a, value, b)
            out.append((str(doc_id), key[2], subroot, root, H(*[a + b for a, b in path + up]), value, value == root))
    return sorted(out)


def answer(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def as_rows(df):
    return [r.asDict() for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


@pytest.mark.parametrize("levels", [4, 1])
def test_whole_table_and_deep_forests(spark, levels, monkeypatch):
    """With one level a block several rounds of blocks are needed."""
    monkeypatch.setattr(M, "LEVELS", levels)
    monkeypatch.setattr(M, "SPAN", 8 ** levels)
    before = M.climb
    if levels == 1:         # workers import the module anew
        monkeypatch.setattr(M, "_up", _with_levels(M._up, levels))
        monkeypatch.setattr(M, "_down", _with_levels(M._down, levels))
        real = M._leaves
        monkeypatch.setattr(M, "_leaves", lambda root: _with_levels(real(root), levels))
    assert M.climb is before
    got = M.manifest(spark.read.parquet(f"{SF}/documents.parquet"))
    want = brute(table(SF, "documents"))
    assert answer(got) == want
    assert any(r[6] for r in want) and not all(r[6] for r in want)


def _with_levels(f, levels):
    def run(batches):
        from tidemark.llm import merkle
        kept = merkle.LEVELS, merkle.SPAN
        merkle.LEVELS, merkle.SPAN = levels, 8 ** levels
        try:
            yield from f(batches)
        finally:
            merkle.LEVELS, merkle.SPAN = kept
    return run


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumn("lang", F.when(F.col("doc_id") > 4, F.lit(None)).when(F.col("doc_id") == 3, "é")
                                           .when(F.col("doc_id") == 4, "").otherwise("en"))
    docs = docs.withColumn("source", F.when(F.col("doc_id") != 2, "sö"))
    assert answer(M.manifest(docs)) == brute(as_rows(docs))


def test_many_languages(spark):
    rows = [(k, f"text {k}", f"l{k % 90}" if k % 91 else None) for k in range(400)] + [(1, "Text", "l1"), (1, "Text", "l1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.select("doc_id", "text", "lang", F.lit("S").alias("source"), F.lit(None).cast("long").alias("n_chars"))
    assert answer(M.manifest(docs)) == brute(as_rows(docs))


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_small_forests(spark, n):
    docs = spark.createDataFrame([(k, f"Text {k}", "en") for k in range(n)], "doc_id long, text string, lang string")
    rows = [dict(doc_id=k, text=f"Text {k}", lang="en", source=None, n_chars=None) for k in range(n)]
    assert answer(M.manifest(docs)) == brute(rows)


def test_empty_table(spark):
    df = M.manifest(empty_documents(spark))
    assert df.collect() == [] and df.columns == [c.split()[0] for c in M._RESULT.split(", ")]


def test_a_wrong_digest_is_found():
    nodes = [H(str(k)) for k in range(100)]
    root, runs = M.climb(nodes, 0, 100)
    assert root == tree(nodes)[0]
    paths = M.descend(runs, 0, 100)
    assert all(M.fold(d, p) == root for d, p in zip(nodes, paths))
    assert M.fold(H("x"), paths[7]) != root and M.fold(nodes[8], paths[7]) != root
    assert M.unpack(M.pack(paths[63])) == paths[63]


def test_registered(spark):
    got = E.queries()["op11_merkle_manifest"](spark, SF)
    assert got.count() == len(table(SF, "documents")) and len(ODD) > 10
