from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import ODD, SF, empty_documents, odd_documents, table
from tidemark.llm import packing as P


def check(rows, lengths, capacities):
    """rows: packed pieces; lengths: [(doc_id, n_tokens)]."""
    pieces = Counter()
    for doc_id, n in lengths:
        top = max(capacities)
        for k in range(-(-n // top)):
            pieces[doc_id, k, k * top, min(n - k * top, top)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.n_tokens) for r in rows) == pieces
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    for held in bins.values():
        held.sort(key=lambda r: r.bin_offset)
        end = 0
        for r in held:
            assert r.bin_offset == end
            end += r.n_tokens
        assert {r.bin_size for r in held} == {min(c for c in capacities if c >= end)}
    return bins


def tokens(rows):
    import public_tokenizers
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path(P.TOKENIZER)))
    return [(d, len(model.encode(t or "")) + 1) for d, t in rows]


def test_lengths_are_token_counts(spark, monkeypatch):
    """Whole texts, also without white space, and long ones cut at words."""
    monkeypatch.setattr(P, "PART_CHARS", 100)
    rows = [*ODD, (20, "abcdefghij" * 900), (21, "日本語のテキスト" * 300), (22, "a,b;c" * 500), (23, "It's  two  spaces\n\nand\ttabs " * 50)]
    rows += [(100 + r["doc_id"], r["text"]) for r in table(SF, "documents")[:40]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in P.token_lengths(docs).collect()) == Counter(tokens(rows))
    assert any(len(P._parts(t or "")) > 3 for _, t in rows)


def test_equal_rows_spread_over_slots(spark):
    df = spark.createDataFrame([(None, 5)] * 4000, "doc_id long, n_tokens long").repartition(4)
    check(P.pack(df, capacities=(16,)).collect(), [(None, 5)] * 4000, (16,))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    lengths = [(r[0], r[1]) for r in P.token_lengths(docs).collect()]
    assert max(n for _, n in lengths) > 30_000 and min(n for _, n in lengths) == 1
    check(P.pack(P.token_lengths(docs)).collect(), lengths, P.CAPACITIES)
    check(P.pack(P.token_lengths(docs), capacities=(7, 3)).collect(), lengths, (7, 3))
    assert P.pack(P.token_lengths(empty_documents(spark))).collect() == []


def test_null_and_small_lengths_count_as_one(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (3, -4), (4, 9)], "doc_id long, n_tokens long")
    check(P.pack(df, capacities=(8,)).collect(), [(1, 1), (2, 1), (3, 1), (4, 9)], (8,))


def test_one_length_for_most_rows(spark):
    lengths = [(k, 3 if k % 3 else 5) for k in range(2000)]
    bins = check(P.pack(spark.createDataFrame(lengths, "doc_id long, n_tokens long"), capacities=(8, 16)).collect(),
                 lengths, (8, 16))
    total = sum(n for _, n in lengths)
    assert total / sum(held[0].bin_size for held in bins.values()) > 0.98


def test_documents(spark):
    rows = P.op8_best_fit_packing(spark, SF).collect()
    lengths = [(r[0], r[1]) for r in P.token_lengths(spark.read.parquet(f"{SF}/documents.parquet")).collect()]
    assert len(lengths) == len(table(SF, "documents"))
    bins = check(rows, lengths, P.CAPACITIES)
    assert sum(n for _, n in lengths) / sum(held[0].bin_size for held in bins.values()) > 0.97


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 30), max_size=12))
def test_plan(histogram):
    plan = P.Plan(histogram, (6, 12, 24))
    fill = Counter()
    placed = Counter()
    for length, rank, n, first, offset in plan.places:
        placed[length] += n
        for b in range(first, first + n):
            fill[b] += length
    assert placed == Counter(histogram)
    assert {b: f for b, f in fill.items()} == {b: used for first, n, _, used in plan.bins for b in range(first, first + n)}
    # no two bins of the largest size could be one
    halves = [used for first, n, size, used in plan.bins for _ in range(n) if used <= 12]
    assert sum(plan.cost(s) * n for _, n, s, _ in plan.bins) <= sum(plan.cost(24) * n for _, n, _, _ in plan.bins)
    assert all(size in (6, 12, 24) and used <= size for _, _, size, used in plan.bins) and halves is not None


def test_the_least_cost_size_is_opened():
    # 5s alone: three in 16 waste 1, one in 8 wastes 3
    plan = P.Plan({5: 30}, (8, 16), cost=lambda c: c)
    assert {size for _, _, size, _ in plan.bins} == {16}
    # but if long sequences cost much more, each 5 takes an 8
    plan = P.Plan({5: 30}, (8, 16), cost=lambda c: c ** 3)
    assert {size for _, _, size, _ in plan.bins} == {8}
