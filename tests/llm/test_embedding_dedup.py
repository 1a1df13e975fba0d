import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.llm.cases import SF, table
from tidemark.llm import embedding_dedup as V


def brute(rows, cosine=V.COSINE):
    """{row number: (n_links, component_id)} by all pairs."""
    good = [k for k, (_, v) in enumerate(rows)
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {k: set() for k in range(len(rows))}
    for size in {len(rows[k][1]) for k in good}:
        at = [k for k in good if len(rows[k][1]) == size]
        x = np.array([rows[k][1] for k in at], dtype=float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for i, j in zip(*np.nonzero(x @ x.T >= cosine)):
            if i != j:
                links[at[i]].add(at[j])
    label = {}
    for k in range(len(rows)):
        if k in label:
            continue
        reach, todo = {k}, [k]
        while todo:
            todo_next = [j for i in todo for j in links[i] if j not in reach]
            reach.update(todo_next)
            todo = todo_next
        ids = [rows[j][0] for j in reach if rows[j][0] is not None]
        for j in reach:
            label[j] = min(ids, default=None) if len(reach) > 1 or j in good else rows[j][0]
    return [(len(links[k]), label[k]) for k in range(len(rows))]


def near(rng, base, n, angle):
    """n unit vectors at the given angle (degrees) from ``base``, in random directions."""
    side = rng.normal(size=(n, len(base)))
    side -= (side @ base)[:, None] * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    a = np.radians(angle)
    return np.cos(a) * base + np.sin(a) * side


def unit(rng, dims=64):
    x = rng.normal(size=dims)
    return x / np.linalg.norm(x)


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def check(spark, rows, kind="double"):
    want = sorted(((i is not None, i or 0), n, (c is not None, c or 0)) for (i, _), (n, c) in zip(rows, brute(rows)))
    got = [((r.vec_id is not None, r.vec_id or 0), r.n_links, (r.component_id is not None, r.component_id or 0))
           for r in V.near_vectors(frame(spark, rows, kind)).collect()]
    assert sorted(got) == want


def test_hadamard_is_an_orthogonal_transform():
    x = np.random.default_rng(1).normal(size=(5, 32))
    matrix = np.array([[(-1) ** bin(i & j).count("1") for j in range(32)] for i in range(32)]) / np.sqrt(32)
    assert np.allclose(V.hadamard(x), x @ matrix) and np.allclose(V.hadamard(V.hadamard(x)), x)


def test_probes_start_at_home_and_follow_the_loss():
    x = V.padded(np.stack([unit(np.random.default_rng(k)) for k in range(50)]), 64)
    buckets = V.table_buckets(x, 64, 3, 2)
    assert all(len(set(row)) == V.PROBES for row in buckets.tolist())
    nearest = [np.abs(V.rotate(x, 6 + k)).argmax(axis=1) for k in (0, 1)]
    best = [V._axes(x, 6 + k)[0][:, 0] // 2 for k in (0, 1)]
    assert all((a == b).all() for a, b in zip(nearest, best))


@pytest.mark.parametrize("vectors", [1_000, 10_000_000])
def test_plan_reaches_its_recall(vectors):
    how = V.plan(vectors, 64)
    rng = np.random.default_rng(11)
    a = np.stack([unit(rng) for _ in range(1500)])
    b = np.stack([near(rng, x, 1, np.degrees(np.arccos(V.COSINE)) - 1e-6)[0] for x in a])
    x, y = V.padded(a, how.width), V.padded(b, how.width)
    met = np.zeros(len(a), bool)
    for t in range(how.tables):
        p, q = (V.table_buckets(z, 64, t, how.rotations) for z in (x, y))
        met |= (p == q[:, :1]).any(axis=1) | (q == p[:, :1]).any(axis=1)
    assert met.all() and ((V.sketches(x) != V.sketches(y)).sum(axis=1) <= how.limit).all()


def test_equal_to_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = []
    # tight groups (cells), loose ones, chains at the threshold and copies
    for spread, n in ((1, 60), (6, 80), (9, 40), (12.5, 40), (17, 25), (25, 25)):
        for v in near(rng, unit(rng), n, spread):
            rows.append(v)
    limit = np.degrees(np.arccos(V.COSINE))
    for gap in (limit - 0.001, limit + 0.001):
        for _ in range(30):
            base = unit(rng)
            rows += [base, near(rng, base, 1, gap)[0]]
    a, b = unit(rng), unit(rng)
    b -= (a @ b) * a
    b /= np.linalg.norm(b)
    rows += [np.cos(np.radians(k * 10)) * a + np.sin(np.radians(k * 10)) * b for k in range(12)]
    rows += [rows[0]] * 50 + [rows[5] * 3.0] * 4 + [unit(rng) for _ in range(200)]
    ids = rng.permutation(len(rows)).tolist()
    check(spark, [(i, v.tolist()) for i, v in zip(ids, rows)])


def test_odd_vectors_and_ids(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v), (2, [2.0, 4.0, 6.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0]),
            (7, [1.0, float("nan"), 2.0]), (8, [float("inf"), 1.0, 1.0]), (9, [-0.0, 1.0, 0.0]), (10, [0.0, 1.0, 0.0]),
            (None, v), (None, None), (11, v), (11, [9.0, -1.0, 0.0]), (12, [-1.0, -2.0, -3.0]), (13, [1.0, 2.0, 3.0, 0.0]),
            (14, [1e-300, 2e-300, 3e-300]), (15, [1e200, 2e200, 3e200]), (16, [5.0]), (17, [2.0]), (18, [-2.0])]
    check(spark, rows)
    odd = frame(spark, [r for r in rows if r[0] not in (14, 15)], "float").select(
        "*", *[F.lit(1).alias(c) for c in ("k", "m", "node", "item", "bucket", "vec", "a", "b", "label")])
    assert V.near_vectors(odd).count() == len(rows) - 2


def test_empty_and_unusable_tables(spark):
    assert V.near_vectors(frame(spark, [])).collect() == []
    (row,) = V.near_vectors(frame(spark, [(4, None)])).collect()
    assert (row.vec_id, row.n_links, row.component_id, row.kept) == (4, 0, 4, True)


def test_dense_group_is_not_paired_up(spark):
    """A hot group costs rows in proportion to its members."""
    rng = np.random.default_rng(5)
    made, real = [], V.stored

    def counting(df, name):
        out = real(df, name)
        made.append((name, out.count()))
        return out

    sizes = {}
    for n in (200, 800):
        rows = [(k, v.tolist()) for k, v in enumerate(near(rng, unit(rng), n, 5))]
        made.clear()
        V.stored = counting
        try:
            got = V.near_vectors(frame(spark, rows)).collect()
        finally:
            V.stored = real
        assert {(r.n_links, r.component_id) for r in got} == {(n - 1, 0)}
        sizes[n] = sum(k for _, k in made)
    assert sizes[800] < 6 * sizes[200]


def test_registered_query_equals_all_pairs(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(SF.replace("0.001", "0.01"), "embeddings")]
    got = E.queries()["op12_embedding_dedup"](spark, SF.replace("0.001", "0.01"))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = {i: (n, c, i == c) for (i, _), (n, c) in zip(rows, brute(rows))}
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()} == want
