import numpy as np
from pyspark.sql import functions as F

from tests.llm.cases import SF, empty_documents, odd_documents, table
from tidemark.llm import language as L


def model_of(spark, sf=SF):
    return L.train(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text"))


def test_held_out_accuracy(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = L.train(docs.where("doc_id % 2 = 0").select("doc_id", "lang", "text"), rows=300)
    rows = L.of_documents(docs.where("doc_id % 2 = 1").withColumn("source", F.lit(None).cast("string"))
                          .withColumnRenamed("lang", "truth").withColumn("lang", F.lit(None).cast("string")))
    found = {r.id: r for r in L.identify(rows, model).collect()}
    truth = {r["doc_id"]: r["lang"] for r in table("/root/testdata/sf0.01", "documents") if r["doc_id"] % 2}
    assert np.mean([found[i].lang == x for i, x in truth.items()]) > 0.97
    assert all(r.accepted for r in found.values())


def test_odd_rows(spark):
    model = model_of(spark)
    got = L.identify(L.of_documents(odd_documents(spark)), model).collect()
    assert len(got) == 13
    by = {r.id: r for r in got}
    assert not by[3].accepted and not by[4].accepted and not by[9].accepted and by[9].lang == "und"
    assert by[1].accepted and by[5].n_letters > 1000
    noise = spark.createDataFrame([(1, None, None, None, "xqzv wkjq qqxz vvkq " * 9)],
                                  "id long, declared string, suffix string, host string, text string")
    assert L.identify(noise, model).first().lang == "und"
    assert L.identify(L.of_documents(empty_documents(spark)), model).collect() == []
    nothing = L.train(empty_documents(spark).select("doc_id", "lang", "text"))
    assert {r.lang for r in L.identify(L.of_documents(odd_documents(spark)), nothing).collect()} == {"und"}


def test_evidence_is_fused(spark):
    model = model_of(spark)
    german = next(r["text"] for r in table(SF, "documents") if r["lang"] == "de")
    rows = [(k, "de-AT", "at", "host.at", german) for k in range(30)] + [
        (100, "de", "at", "host.at", "en"), (101, "zz-!!", "at", "host.at", "en"), (102, None, None, None, "en"),
        (103, None, "at", "other.at", "en"), (104, "de", None, None, None)]
    df = spark.createDataFrame(rows, "id long, declared string, suffix string, host string, text string")
    got = {r.id: r for r in L.identify(df, model).collect()}
    assert got[0].declared == "de" and got[0].lang == "de"
    # two letters decide nothing; host, then suffix, then declaration do
    assert got[100].lang == "de" and got[101].lang == "de" and got[103].lang == "de"
    assert got[100].posterior >= got[101].posterior
    assert not got[104].accepted and got[101].declared is None


def test_pages(spark):
    got = {r.page_id: r for r in L.language_id_pages(spark, SF).collect()}
    pages = table(SF, "pages")
    assert len(got) == len(pages)
    assert np.mean([got[p["page_id"]].lang == got[p["page_id"]].declared for p in pages]) > 0.95


def test_a_rare_language_is_a_class_at_every_size(spark):
    """Whatever the ids: shared, null, or few rows among very many."""
    ids = lambda k: (None, 7, k)[k % 3]
    rows = [(ids(k), "en", f"the house number {k} is on the hill and it was sold") for k in range(4000)]
    rows += [(5, "xx", f"zyxo wuvi qruz {k} vyx zoqu") for k in range(3)] + [(None, "yy", "ðæþ ðæþø")]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    names, table = L.train(df, rows=20)
    assert names == ["en", "xx", "yy"]
    got = L.identify(L.of_documents(df.where("lang = 'xx'").withColumn("lang", F.lit(None).cast("string"))
                                    .withColumn("source", F.lit(None).cast("string"))), (names, table)).collect()
    assert [r.lang for r in got] == ["xx"] * 3


def test_markup_language_far_down_the_page(spark):
    pages = ["<!-- " + "licence " * 400 + "--><html lang=de><p>x", " " * 5000 + "<!DOCTYPE html>\n<HTML class=a lang='fr-CA'>",
             "<!-- <html lang=en> --><html lang=es>", "<html><script>'<html lang=en>'</script>", "<!-- <html lang=en>", None]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    assert [r.declared for r in sorted(L.of_pages(df).collect(), key=lambda r: r.id)] == ["de", "fr-CA", "es", None, None, None]


def test_own_evidence_does_not_count_twice(spark):
    """A host's only page is judged by the suffix, not by itself."""
    model = model_of(spark)
    text = next(r["text"] for r in table(SF, "documents") if r["lang"] == "es")
    one = spark.createDataFrame([(1, None, None, "only.example", text), (2, None, None, None, text)],
                                "id long, declared string, suffix string, host string, text string")
    a, b = sorted(L.identify(one, model).collect(), key=lambda r: r.id)
    assert a.lang == b.lang == "es" and abs(a.posterior - b.posterior) < 1e-3


def test_many_labels_are_rows_not_columns(spark):
    """Labels are data: their number makes no plan wider."""
    rows = [(k, f"l{k % 150}", f"s{k % 7}", f"word{k % 150} other{k % 150} third{k % 150} " * 3) for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    model = L.train(df)
    assert len(model[0]) == 150
    got = L.identify(L.of_documents(df), model)
    assert len(got.columns) == 7 and got.count() == 900
    assert L.train(df.where("false"))[0] == []
