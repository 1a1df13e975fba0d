"""Corpus preparation: each stage reads what the one before it kept.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and
returns a DataFrame with the columns of documents; the last one returns the
packed pieces.  A stage reads doc_id, text, lang and source and passes other
columns on untouched.  Defined results: an empty table passes every stage; of
rows with equal texts one stays; every stage judges each row by itself, also
rows of different texts that share a doc_id (null included).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, exact_dedup, language, near_dedup, packing
from tidemark.llm.common import documents, stored


def _key(docs: DataFrame, columns=("doc_id", "lang", "source", "text")) -> Column:
    """64 bits of what the stages read of a row; only equal rows share them."""
    return F.xxhash64(*[docs[c] for c in columns if c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the known languages stay, with the language found."""
    model = language.train(docs.select("doc_id", "lang", "text"))
    found = language.identify(language.of_documents(docs.withColumn("doc_id", _key(docs))), model)
    # equal rows have one verdict
    one = (found.where("accepted").groupBy(F.col("id").alias("kept_key"))
           .agg(F.min("lang").alias("kept_lang")))
    return (docs.join(one, _key(docs) == one.kept_key)
            .select(*[one.kept_lang.alias("lang") if c == "lang" else docs[c] for c in docs.columns]))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays, and one of rows that repeat it."""
    kept = exact_dedup.exact_dedup(docs).where("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha")).distinct()
    sha = "sha"
    while sha in docs.columns:
        sha += "_"
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), decontaminate.UPPER, decontaminate.LOWER)
    signed = docs.withColumn(sha, F.sha2(text, 256))
    return (signed.join(kept, signed.doc_id.eqNullSafe(kept.kept_id) & (signed[sha] == kept.kept_sha), "left_semi")
            .dropDuplicates(["doc_id", sha]).select(docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the smallest doc_id;
    rows without an id of their own come last."""
    columns, shared, rows = docs.columns, "shared_id", docs
    while shared in columns:
        shared += "_"
    repeated = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias(shared)).count().where("count > 1").select(shared)
    own = docs.doc_id.cast("long")
    if repeated.limit(1).count():
        rows = docs.join(repeated, docs.doc_id == repeated[shared], "left")
        own = F.when(rows[shared].isNull(), rows["doc_id"].cast("long"))
    # a hash beyond the usual ids
    own = F.coalesce(own, _key(rows, ("doc_id", "text")).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62)))
    found = near_dedup.near_duplicates(rows.withColumn("doc_id", own))
    kept = found.where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return rows.join(kept, own == kept.kept_id, "left_semi").select(columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    found = decontaminate.decontaminate(docs.withColumn("doc_id", _key(docs)),
                                        spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaks = found.where("n_hit > 0").select(F.col("doc_id").alias("leak_key")).distinct()
    return docs.join(leaks, _key(docs) == leaks.leak_key, "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their bin, offset and bin size."""
    return packing.pack(packing.token_lengths(docs))


STAGES = [
    ("language", identify_language),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# language models, signatures and the packing have no SQL form; the stages are
# tested against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
