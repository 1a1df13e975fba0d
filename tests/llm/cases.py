"""Small inputs that every operator must answer, and brute-force answers."""

import re

ODD = [
    (1, "Same text here, five words and more of them"),
    (2, "SAME text here, five words and more of them"),
    (2, "SAME text here, five words and more of them"),
    (3, None),
    (4, ""),
    (None, "a row without an id"),
    (None, None),
    (5, "ü" * 700 + " token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" " + "ü" * 700),
    (6, "word " * 30_000),
    (7, "one"),
    (8, "ends\n\nin odd\x00 bytes \U0001F600 and tabs\t"),
    (9, "%%% &&& ***"),
    (10, "mail a.b@c-d.example.org, 10.0.0.1, 4111 1111 1111 1111, +1 (555) 010-9999"),
]

# extra columns whose names the operators use inside
CLASHING = ["h", "n", "hash", "content", "lo", "rank", "slot", "salt", "start", "mark", "node", "bucket", "sig",
            "sim", "p", "spans", "window", "k1", "size", "host", "suffix", "declared", "id", "email", "found_lang"]


def odd_documents(spark, rows=ODD):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("src").alias("source"),
                       F.length("text").cast("long").alias("n_chars"),
                       *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)])
    return docs.repartition(3)


def empty_documents(spark):
    return odd_documents(spark).where("false")


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(_LOWER)


def words(text):
    return WORD.findall(lower(text))


def table(sf, name):
    import pyarrow.parquet as pq
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


SF = "/root/testdata/sf0.001"
