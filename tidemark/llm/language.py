"""Language identification by Bayesian evidence fusion.

Evidence per row: the likelihood of its text under letter-trigram models, the
language its markup declares, and a prior of its host that is smoothed towards
its address suffix, which is smoothed towards the whole corpus.  One pass
scores the texts and stores the scores; grouped aggregations over the
text-only posteriors then give how reliable each declaration is and the counts
behind the priors, and a row's own share is taken out of its host's counts
before they are used on it.  The class ``und`` (no language) competes with a
uniform trigram model.

The languages are those of all labelled rows with letters.  The trigram models
are fitted on about ``TRAIN_ROWS`` different texts, as many of each language if
there are, chosen by a hash of the text; everything else is computed over all
rows.

Defined results: null and empty texts, and texts without letters, have no text
evidence and are ``und``, not accepted; a missing or malformed declaration, host
or suffix is no evidence; repeated rows are answered each; an empty table gives
an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, slices, stored, utf8, with_missing_columns

BUCKETS = 1 << 14
TRAIN_ROWS = 8000
LEAST_OF_EACH = 50
UNDETERMINED = "und"
# neighbouring trigrams repeat each other's evidence, and long texts need no more
TEMPER, ENOUGH = 0.5, 200
SUFFIX_WEIGHT, HOST_WEIGHT, DECLARED_WEIGHT = 50.0, 20.0, 5.0
# share of a trigram model that is uniform, and how far below uniform "no language" lies
UNSEEN, MARGIN = 0.1, 1.0
UNDETERMINED_PRIOR = 0.01
ACCEPT = 0.5

_CODE = np.zeros(256, np.uint32)
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
_CODE[128:] = np.arange(27, 155)


def trigrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of each trigram whose middle byte is of a letter."""
    n = len(data)
    if n < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = data
    latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    if len(latin):
        low = data.copy()
        low[latin] += 0x20
    code = np.zeros(n + 2, np.uint32)
    code[1:-1] = _CODE[low]
    before, after = code[:-2].copy(), code[2:].copy()
    edge = off[(off > 0) & (off < n)]
    before[edge] = 0
    after[edge - 1] = 0
    at = np.flatnonzero(code[1:-1])
    packed = (before[at] * np.uint32(155) + code[at + 1]) * np.uint32(155) + after[at]
    bucket = ((packed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(50)).astype(np.int64)
    return bucket, np.searchsorted(off, at, side="right") - 1


def _count(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            bucket, row = trigrams(*utf8(part.column(1)))
            names, of_row = np.unique(np.array(part.column(0).to_pylist(), dtype=object).astype(str), return_inverse=True)
            key, n = np.unique(of_row[row] * BUCKETS + bucket, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[key // BUCKETS].tolist(), pa.string()), pa.array(key % BUCKETS), pa.array(n)],
                names=["lang", "bucket", "n"])


def train(labelled: DataFrame, *, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each bucket) from rows of (doc_id, lang, text)."""
    labelled = labelled.where("lang is not null")
    # different texts of each language: rows that repeat each other count once
    totals = {r[0]: r[1] for r in labelled.groupBy("lang").agg(F.approx_count_distinct("text")).collect()}
    each = max(LEAST_OF_EACH, rows // max(1, len(totals)))
    crowded = {x: n // each for x, n in totals.items() if n >= 2 * each}
    every = F.lit(1)
    if crowded:
        rate = F.create_map(*[F.lit(y) for pair in crowded.items() for y in pair])
        every = F.coalesce(F.try_element_at(rate, F.col("lang")), every)
    sample = labelled.where(F.pmod(F.xxhash64("text"), every) == 0).select("lang", "text").distinct()
    counts = (sample.mapInArrow(_count, "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect())
    names = sorted({r[0] for r in counts})
    table = np.zeros((len(names), BUCKETS))
    for lang, bucket, n in counts:
        table[names.index(lang), bucket] += n
    seen = table / np.maximum(table.sum(axis=1, keepdims=True), 1)
    return names, np.log((1 - UNSEEN) * seen + UNSEEN / BUCKETS)


def _softmax(logs: np.ndarray) -> np.ndarray:
    """Rows of log weights (classes x rows) as shares."""
    e = np.exp(logs - logs.max(axis=0, keepdims=True))
    return e / e.sum(axis=0, keepdims=True)


def _score(names: list[str], model: np.ndarray):
    """Text evidence: ll (log likelihood) and p (share by text alone) of each class."""
    k = len(names) + 1
    flat = np.append(np.full(k - 1, np.log((1 - UNDETERMINED_PRIOR) / max(1, k - 1))), np.log(UNDETERMINED_PRIOR))

    def score(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                data, off = utf8(part.column(part.num_columns - 1))
                bucket, row = trigrams(data, off)
                n = np.bincount(row, minlength=len(part))
                weight = TEMPER * np.minimum(n, ENOUGH) / np.maximum(n, 1)
                ll = [weight * np.bincount(row, weights=m[bucket], minlength=len(part)) for m in model]
                ll = np.stack(ll + [-(np.log(BUCKETS) + MARGIN) * weight * n])
                p = _softmax(ll + flat[:, None]) * (n > 0)
                ends = pa.array(np.arange(len(part) + 1) * k, pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.T.reshape(-1))) for x in (ll, p)]
                yield pa.RecordBatch.from_arrays(list(part.columns[:-1]) + [pa.array(n, pa.int64()), *lists],
                                                 names=list(part.schema.names[:-1]) + ["n_letters", "l", "p"])
    return score


def _fuse(classes: list[str], overall: np.ndarray, claimed: np.ndarray, kinds: int):
    """Posterior from text, declaration and smoothed host prior, a row's own share
    taken out of the counts it is judged by."""
    k = len(classes)

    def fuse(batches):
        for batch in batches:
            table = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            known = lambda c: pc.is_valid(table[c]).to_numpy(zero_copy_only=False)

            def take(name):
                """A list column as classes x rows, zero where it is null."""
                out = np.zeros((len(batch), k))
                out[known(name)] = pc.list_flatten(table[name]).to_numpy().reshape(-1, k)
                return out.T
            count = lambda c: pc.fill_null(table[c], 0).to_numpy(zero_copy_only=False)
            n, mine = count("n_letters"), take("p")
            own = (n > 0).astype(float)
            suffix = (np.maximum(take("s") - mine, 0) + SUFFIX_WEIGHT * overall[:, None]) / (
                np.maximum(count("s_n") - own, 0) + SUFFIX_WEIGHT)
            suffix = np.where(known("suffix") & known("s_n"), suffix, overall[:, None])
            host = (np.maximum(take("h") - mine, 0) + HOST_WEIGHT * suffix) / (
                np.maximum(count("h_n") - own, 0) + HOST_WEIGHT)
            prior = np.where(known("host") & known("h_n"), host, suffix)
            claim = np.log((np.maximum(take("c") - mine, 0) + DECLARED_WEIGHT / kinds)
                           / (np.maximum(claimed[:, None] - mine, 0) + DECLARED_WEIGHT))
            claim = np.where(known("declared") & known("c"), claim, 0.0)
            q = _softmax(take("l") + np.log(prior) + claim)
            best, top = q.argmax(axis=0), np.round(q.max(axis=0), 6)
            text = mine.argmax(axis=0)
            lang = np.where(n > 0, best, k - 1)
            top = np.where(n > 0, top, 0.0)
            yield pa.RecordBatch.from_arrays(
                [table["id"], pa.array([classes[i] for i in lang]), pa.array(top),
                 pa.array([classes[i] for i in np.where(n > 0, text, k - 1)]), table["declared"], table["n_letters"],
                 pa.array((lang < k - 1) & (top >= ACCEPT))],
                names=["id", "lang", "posterior", "text_lang", "declared", "n_letters", "accepted"])
    return fuse


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """Fuse the evidence of rows (id, declared, suffix, host, text).

    Returns id, lang, posterior, text_lang, declared, n_letters, accepted."""
    names, table = model
    classes = names + [UNDETERMINED]
    k = len(classes)
    declared = F.regexp_extract(F.lower(F.trim(F.coalesce("declared", F.lit("")))), r"^([a-z]{2,3})(?:[-_][a-z0-9]{1,8})*$", 1)
    rows = rows.select("id", F.when(declared != "", declared).alias("declared"),
                       F.lower(F.col("suffix")).alias("suffix"), F.lower(F.col("host")).alias("host"), "text")
    schema = "id long, declared string, suffix string, host string, n_letters long, l array<double>, p array<double>"
    scored = stored(rows.mapInArrow(_score(names, table), schema), "language")
    # one row per class: labels are data, so they are no columns
    shares = scored.where("n_letters > 0").select("suffix", "host", "declared", F.posexplode("p").alias("class", "x"))
    by_host = stored(shares.groupBy("suffix", "host", "class").agg(F.sum("x").alias("x"), F.count("*").alias("n")), "hosts")
    vector = F.transform(F.array_sort(F.collect_list(F.struct("class", "x"))), lambda s: s["x"])
    total = [F.sum("x").alias("x"), F.sum("n").alias("n")]
    hosts = by_host.groupBy("suffix", "host").agg(F.max("n").alias("h_n"), vector.alias("h"))
    suffixes = by_host.groupBy("suffix", "class").agg(*total).groupBy("suffix").agg(F.max("n").alias("s_n"), vector.alias("s"))
    claims = (shares.where("declared is not null").groupBy("declared", "class").agg(F.sum("x").alias("x"))
              .groupBy("declared").agg(vector.alias("c")))
    # one row per class, as the model has
    whole = {r["class"]: (r["x"], r["n"]) for r in by_host.groupBy("class").agg(*total).collect()}
    overall = np.array([((whole[i][0] if i in whole else 0.0) + 1.0) / ((whole[i][1] if i in whole else 0) + k) for i in range(k)])
    claimed_by = {r[0]: r[1:] for r in claims.select(F.posexplode("c").alias("class", "x")).groupBy("class").agg(
        F.sum("x"), F.count("*")).collect()}
    claimed = np.array([claimed_by[i][0] if i in claimed_by else 0.0 for i in range(k)])
    kinds = (claimed_by[0][1] if claimed_by else 0) + 1

    joined = (scored.join(hosts.where("host is not null").select(F.col("suffix").alias("h_suffix"), F.col("host").alias("h_host"),
                                                                 "h_n", "h"),
                          F.col("suffix").eqNullSafe(F.col("h_suffix")) & (F.col("host") == F.col("h_host")), "left")
              .join(suffixes.where("suffix is not null"), "suffix", "left").join(claims, "declared", "left"))
    return joined.mapInArrow(
        _fuse(classes, overall, claimed, kinds),
        "id long, lang string, posterior double, text_lang string, declared string, n_letters long, accepted boolean")


def of_documents(docs: DataFrame) -> DataFrame:
    """Documents as evidence rows: the declared language, the source as host."""
    return with_missing_columns(docs, doc_id="long", lang="string", source="string", text="string").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"),
        F.col("source").alias("host"), "text")


def of_pages(pages: DataFrame) -> DataFrame:
    """Pages as evidence rows: the markup's language, host and suffix of the address."""
    page = with_missing_columns(pages, page_id="long", url="string", html="string")
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^[a-z]+://(?:[^/@]*@)?([^/:?#]+)", 1)
    # the first html tag outside comments, however far down it stands
    tag = F.regexp_extract(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<!--.*?(?:-->|\z)", " "),
                           r"(?i)<html\b[^>]*+", 0)
    markup = F.regexp_extract(tag, r"(?i)\slang\s*=\s*[\"']?([A-Za-z_-]+)", 1)
    text = F.regexp_replace(F.coalesce("html", F.lit("")),
                            r"(?is)<script\b.*?</script>|<style\b.*?</style>|<[^>]*>|&[a-z]{2,8};", " ")
    return page.select(F.col("page_id").alias("id"), F.when(markup != "", markup).alias("declared"),
                       F.when(host != "", F.regexp_extract(host, r"([^.]+)$", 1)).alias("suffix"),
                       F.when(host != "", host).alias("host"), text.alias("text"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return identify(of_documents(docs), train(docs.select("doc_id", "lang", "text"))).withColumnRenamed("id", "doc_id")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = train(documents(spark, sf_dir).select("doc_id", "lang", "text"))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return identify(of_pages(pages), model).withColumnRenamed("id", "page_id")
