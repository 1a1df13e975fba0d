import hashlib
from collections import defaultdict

from tests.llm.cases import ODD, SF, empty_documents, lower, odd_documents, table
from tidemark.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lower(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_odd_rows(spark):
    assert found(exact_dedup.exact_dedup(odd_documents(spark))) == expected(ODD)
    assert found(exact_dedup.exact_dedup(empty_documents(spark))) == []


def test_overflow_is_dealt_anew(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(SF, "documents")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # tables of 20 kB: most contents overflow, some several times
    assert found(exact_dedup.exact_dedup(docs, bucket_bytes=20_000)) == expected(rows)
    assert found(exact_dedup.op9_exact_dedup(spark, SF)) == expected(rows)


def test_table_compares_contents():
    table = exact_dedup.ContentTable(1 << 20)
    for k in range(3000):
        assert table.add(k % 1500 % 7, b"%d" % (k % 1500), k, 1)      # seven hashes for 1500 contents
    assert len(table.rows) == 1500 and all(r[3] == 2 for r in table.rows)
    small = exact_dedup.ContentTable(10)
    assert small.add(1, b"longer than the limit", 1, 1) and not small.add(2, b"x", 1, 1)


def test_bounded_fan_out(spark, monkeypatch):
    """Many more buckets than one shuffle makes: inner buckets, each with its own table."""
    monkeypatch.setattr(exact_dedup, "FAN_OUT", 3)
    rows = [(k, f"Text {k % 400} " + "x" * (k % 50)) for k in range(1200)] + [(None, "text 1 x")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, exact_dedup.exact_dedup(docs, bucket_bytes=2000).select("doc_id", "keep_id", "group_size", "kept").collect()), key=str)
    whole = sorted(map(tuple, exact_dedup.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept").collect()), key=str)
    assert got == whole
