from collections import Counter, defaultdict

import numpy as np

from tests.llm.cases import ODD, empty_documents, odd_documents, table, words
from tidemark.llm import near_dedup as D


def bag(text):
    w = words(text)
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def classes(rows):
    """{doc_id: smallest doc_id of its class}, by exact overlaps of all texts that share a shingle."""
    bags = {i: bag(t) for i, t in rows if i is not None}
    holders, parent = defaultdict(list), {i: i for i in bags}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, b in bags.items():
        for s in b:
            holders[s].append(i)
    for i, b in bags.items():
        both = Counter()
        for s, n in b.items():
            for j in holders[s]:
                if j < i:
                    both[j] += min(n, bags[j][s])
        for j, n in both.items():
            if n >= 0.8 * (sum(b.values()) + sum(bags[j].values()) - n) - 1e-9:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in bags}


def check(df, rows):
    got = {r.doc_id: r.class_id for r in df.collect() if r.doc_id is not None}
    assert got == classes(rows)
    assert df.count() == len(rows)
    assert df.where("kept and doc_id is not null").select("doc_id").distinct().count() == len(set(got.values()))


def test_odd_rows(spark):
    check(D.near_duplicates(odd_documents(spark)), ODD)
    assert D.near_duplicates(empty_documents(spark)).collect() == []
    assert {r.class_id for r in D.near_duplicates(odd_documents(spark)).where("doc_id is null").collect()} == {None}


def test_documents(spark):
    sf = "/root/testdata/sf0.01"
    check(D.op5_near_dedup(spark, sf), [(r["doc_id"], r["text"]) for r in table(sf, "documents")])


def test_large_group_without_its_origin(spark):
    """Copies of one text with several words changed: most pairs lie near the threshold."""
    rng = np.random.default_rng(4)
    origin = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(300):
        text = list(origin)
        for at in rng.integers(0, 150, int(rng.integers(0, 8))):
            text[at] = f"x{rng.integers(1000)}"
        if k % 3 == 0:
            text = text[:int(rng.integers(110, 150))]
        rows.append((k, " ".join(text)))
    rows += [(500 + k, "the same line " * n) for k, n in enumerate((20, 21, 24, 40))]
    check(D.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_signatures_are_unbiased():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(40):
        h = rng.integers(1, 1 << 62, 200).astype(np.uint64)
        a = rng.integers(0, 9, 200)
        b = np.where(rng.random(200) < 0.7, a, rng.integers(0, 30, 200))
        row = np.concatenate((np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)))
        s = D.signatures(row, np.concatenate((h[a > 0], h[b > 0])), np.concatenate((a[a > 0], b[b > 0])), 2, 512)
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.03


def test_components(spark):
    edges = [(k + 1, k) for k in range(40)] + [(100, 99), (7, 7)] + [(k, 200) for k in range(201, 260)]
    got = {r.node: r.comp for r in D.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(41)} == {0} and got[100] == got[99] == 99 and {got[k] for k in range(200, 260)} == {200}


def near(text, *places):
    out = text.split()
    for k in places:
        out[k] = f"other{k}"
    return " ".join(out)


def test_rows_are_judged_by_their_own_text(spark):
    """Rows that share an id, or have none, link what they link and nothing else."""
    a, b = " ".join(f"a{k}" for k in range(200)), " ".join(f"b{k}" for k in range(200))
    rows = [(1, a), (2, near(a, 100)), (2, b), (3, near(b, 50)), (4, "clean and alone in all of this"),
            # 5 and 6 are alike only by way of a row without an id
            (5, near(a, *range(0, 30)).replace("a", "c")), (None, near(a, *range(0, 15)).replace("a", "c")), (6, a.replace("a", "c")),
            (None, "without an id, as one"), (None, "without an id, as one")]
    got = sorted(((r.doc_id or 0, r.class_id or 0, r.kept) for r in D.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()))
    assert got == sorted([(1, 1, True), (2, 1, False), (2, 2, True), (3, 2, False), (4, 4, True),
                          (5, 5, True), (0, 5, False), (6, 5, False), (0, 0, True), (0, 0, True)])


def test_equal_rows_without_ids_are_one_text(spark):
    rows = [(None, "the same text again and again, in every row of it")] * 500 + [(7, "The same text again and again in every row of it")]
    got = D.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("doc_id", "class_id", "kept").count().collect()
    assert sorted((r.doc_id or 0, r.class_id, r.kept, r["count"]) for r in got) == [(0, 7, False, 500), (7, 7, True, 1)]


def test_blocks_find_every_connection(monkeypatch):
    """The matrix product against overlaps of all pairs, with multiplicities."""
    rng = np.random.default_rng(8)
    for _ in range(30):
        pivot = Counter(rng.integers(0, 40, 60).tolist())
        bags = []
        for _ in range(25):
            b = Counter(pivot)
            for t in rng.integers(0, 60, int(rng.integers(0, 25))).tolist():
                b[t] = max(0, b[t] + int(rng.integers(-2, 3)))
            bags.append(+b)
        rows = []
        for k, b in enumerate(bags):
            tokens = [t * 100 + j for t in set(b) | set(pivot) for j in range(min(b[t], pivot[t]), max(b[t], pivot[t]))]
            rows.append((k, k // 2, sum(b.values()), 2 * sum((b & pivot).values()) - sum(pivot.values()), np.array(tokens, np.int64)))
        import pyarrow as pa
        table = [pa.array([7] * 25), pa.array([0] * 25), pa.array([0] * 25), *[pa.array([r[k] for r in rows]) for k in range(4)],
                 pa.array([r[4].tolist() for r in rows], pa.list_(pa.int64()))]
        batch = pa.RecordBatch.from_arrays(table, names=list("bijncszt"))
        found = [tuple(x) for part in D._between(0.8)([batch.slice(0, 9), batch.slice(9)]) for x in zip(*part.to_pydict().values())]
        parent = list(range(13))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        def partition(pairs):
            parent[:] = range(13)
            for i, j in pairs:
                parent[find(i // 2)] = find(j // 2)
            return [[find(i) == find(j) for j in range(13)] for i in range(13)]
        links = [(i, j) for i in range(25) for j in range(i)
                 if sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values()) - 1e-9]
        assert partition(found) == partition(links)


def test_many_texts_below_the_threshold_of_one(spark, monkeypatch):
    """Texts outside the pivot's component in several blocks."""
    monkeypatch.setattr(D, "BLOCK_MEMBERS", 16)
    rng = np.random.default_rng(6)
    origin = [f"w{k}" for k in range(100)]
    rows = [(0, " ".join(origin))]
    for k in range(1, 160):
        text = list(origin)
        for at in rng.integers(0, 100, int(rng.integers(3, 6))):
            text[at] = f"x{k // 2 if k % 2 else k}-{at}"
        rows.append((k, " ".join(text)))
    check(D.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), rows)
