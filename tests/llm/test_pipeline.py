import corpus_pipeline as P
from tests.llm import test_decontaminate, test_near_dedup, test_packing
from tests.llm.cases import SF, empty_documents, lower, odd_documents, table
from tidemark.llm import packing
from tidemark.llm.common import stored


def test_stages_against_brute_force(spark):
    rows = table(SF, "documents")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    have = {r["doc_id"]: r["text"] for r in rows}
    items = [(r["item_id"], r["text"]) for r in table(SF, "benchmark")]
    for name, stage in P.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), "test")
        assert docs.columns == columns
        if name == "exact dedup":
            last = {lower(t): i for i, t in sorted(have.items())}
            have = {i: t for i, t in have.items() if last[lower(t)] == i}
        elif name == "near dedup":
            of = test_near_dedup.classes(have.items())
            have = {i: t for i, t in have.items() if of[i] == i}
        elif name == "decontamination":
            bad = {r[0] for r in test_decontaminate.expected(have.items(), items) if r[5]}
            assert bad
            have = {i: t for i, t in have.items() if i not in bad}
        assert {r.doc_id: r.text for r in docs.collect()} == have, name
    packed = P.STAGES[-1][1](spark, docs, SF).collect()
    test_packing.check(packed, test_packing.tokens(have.items()), packing.CAPACITIES)
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, packed))


def test_odd_and_empty_documents(spark):
    for docs in (odd_documents(spark), empty_documents(spark)):
        columns = docs.columns
        for name, stage in P.STAGES:
            docs = stored(stage(spark, docs, SF), "test")
            assert name == "packing" or docs.columns == columns
            if name == "exact dedup":
                ids = [r.doc_id for r in docs.collect()]
                assert len(ids) == len(set(ids))


def test_rows_that_share_an_id_are_judged_by_themselves(spark):
    leak = max((r["text"] for r in table(SF, "benchmark")), key=len)
    texts = [r["text"] for r in table(SF, "documents") if r["lang"] == "en" and len(r["text"].split()) > 60][:3]
    near = texts[0] + " end"
    kind = "doc_id long, text string, lang string, source string"

    def left(name, rows):
        docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], kind)
        return sorted((r.doc_id or 0, r.text) for r in dict(P.STAGES)[name](spark, docs, SF).collect())

    for i in (None, 7):
        clean = [(i, texts[1]), (i, texts[2])]
        kept = sorted((i or 0, t) for t in texts[1:])
        assert left("decontamination", clean + [(i, leak)]) == kept
        assert left("language", clean + [(i, "12 34 56")]) == kept
        assert len(left("near dedup", clean + [(i, texts[0]), (i, near)])) == 3
        # a row with an id of its own stays before the others
        assert left("near dedup", clean + [(i, near), (9, texts[0])]) == sorted(kept + [(9, texts[0])])
