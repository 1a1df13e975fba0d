"""Personal data by candidate gradient boosting, in DataFrame operations only.

Base kinds (email, ip, card, phone) have fixed formats.  Beside them,
high-recall generators propose spans that may overlap: runs of digits with
separators, and written-out addresses ("name (at) host dot org").  Boosted
trees score a proposal by its format and context.  A number is labelled as
personal if a base span overlaps it or it is certain by itself: right behind a
word such as "tel" or "IBAN", of fitting length and no date.  An address is
labelled if it ends in a known top-level domain and brackets its at or its dot,
or stands behind a word such as "mail".  The trees are fitted on a bounded
sample of each generator's proposals of either label (``CELL_ROWS``), so a rare
kind is learned at every size of table.  A threshold per generator is
calibrated on all proposals outside that sample, so that the expected share of
personal data in what it selects is at least ``PRECISION``, by the rule of
succession: few proposals prove little, and no table size is a case of its own.  Certain proposals are reported without
the trees, which add those like them.  The trees become one SQL expression, so
scoring stays inside the scan of the stored proposals: no shuffle, no join.

The patterns are written for the JVM's regex engine on texts of any length:
loops run over single character classes (which do not recurse), runs are
entered at their start only, and repeated groups are bounded.  E-mail domains,
whose repeated group is not bounded, are cut by plain string functions.

Defined results: null is the empty text, without spans; offsets are code
points, ends exclusive; repeated rows are answered each; without proposals of
both labels, only base spans and certain proposals are reported;
extra columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, stored

CELL_ROWS = 5_000         # for fitting, of each generator and label
PRECISION = 0.95
TREES, DEPTH = 20, 3
CONTEXT = 24

# fixed values: kinds in the order in which spans are listed
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("number", "address")

LOCAL, LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
# a run of parts is entered at its start, which is where the leftmost match begins
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# whole runs of 16 to 19 digits with single separators
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
NUMBER = r"(?<![0-9])[(0-9][0-9 ().-]{5,24}[0-9]"
DOT = r"(?: ?(?:\(dot\)|\[dot\]|dot) ?|\.)"
ADDRESS = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,40}+ ?(?:\(at\)|\[at\]|at) ?[A-Za-z0-9-]{2,40}+"
           rf"(?:{DOT}[A-Za-z0-9-]{{2,40}}+){{0,3}}{DOT}[A-Za-z]{{2,10}}+")
WRITTEN_OUT = r"(?i)[\[( ]dot[\]) ]|[\[(]at[\])]"
KEYWORDS = (r"(tel|phone|call|fax|mobile|mobil|card|carte|karte|tarjeta|ssn|social|iban|konto|account|passport|"
            r"mail|contact|kontakt|llame|appel)[^a-z]*$")
# what makes a proposal certain: the words before it, and what it may not be
FILLER = r"[^a-z0-9]*(?:(?:number|numero|nummer|num|no|nr|is|me|us|at)[^a-z0-9]+){0,3}$"
CALLED = (r"(?<![a-z])(?:tel|telefono?|telefone|(?:tele|cell|mobile)?phone|cell|call|fax|telefax|mobile?|handy|"
          r"contact|kontakt|llame|appel|appelez)" + FILLER)
NUMBERED = (r"(?<![a-z])(?:card|carte|karte|kreditkarte|tarjeta|ssn|social security|iban|konto|kontonummer|account|"
            r"passport)" + FILLER)
MAILED = r"(?<![a-z])(?:e-?mail|mail|contact|kontakt)[^a-z0-9]*(?:(?:address|me|us|is|at)[^a-z0-9]+){0,3}$"
YEAR = "(?:19|20)[0-9]{2}"
DATE = (rf"^\(?(?:{YEAR}[-./ ][0-9]{{1,2}}[-./ ][0-9]{{1,2}}|[0-9]{{1,2}}[-./ ][0-9]{{1,2}}[-./ ]{YEAR}|"
        rf"{YEAR} ?- ?{YEAR})(?![0-9])")
TOP_LEVEL = (r"(?:com|org|net|edu|gov|mil|int|info|biz|name|io|co|me|tv|eu|uk|us|ca|au|nz|ie|de|at|ch|fr|be|nl|lu|es|"
             r"pt|it|dk|se|no|fi|pl|cz|gr|ro|hu|ru|ua|tr|il|in|cn|jp|kr|br|mx|ar|cl|pe|za|example|test)$")
BLOCK = 256

SPAN = "array<struct<start:int,end:int,value:string,before:string,after:string>>"


def empty(kind: str) -> Column:
    return F.array().cast(kind)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: inside higher-order
    functions the engine does not share common expressions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(lengths: Column) -> Column:
    """Sums before each element, block by block: appending to one array per
    element would be quadratic in texts full of matches."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK))
    grown = F.aggregate(
        blocks, F.struct(F.lit(0).alias("sum"), empty("array<array<int>>").alias("out")),
        lambda acc, block: F.aggregate(
            block, F.struct(acc["sum"].alias("sum"), empty("array<int>").alias("run"), acc["out"].alias("out")),
            lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["run"], F.array(a["sum"])).alias("run"),
                                  a["out"].alias("out")),
            lambda a: F.struct(a["sum"].alias("sum"), F.concat(a["out"], F.array(a["run"])).alias("out"))),
        lambda acc: F.flatten(acc["out"]))
    return F.when(F.size(lengths) > 0, grown).otherwise(empty("array<int>"))


def located(text: Column, pattern: str) -> Column:
    """All matches with their places, from the pieces between them."""
    def places(values: Column, gaps: Column, at: Column) -> Column:
        return F.transform(values, lambda v, i: F.struct(
            (F.get(at, i) + F.length(F.get(gaps, i))).alias("start"),
            (F.get(at, i) + F.length(F.get(gaps, i)) + F.length(v)).alias("end"), v.alias("value"),
            F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get(gaps, i + 1), F.lit(1)).alias("after")))

    steps = lambda values, gaps: F.transform(
        values, lambda v, i: F.length(F.get(gaps, i)) + F.length(v))
    return let(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)),
               lambda values: let(F.split(text, pattern, -1),
                                  lambda gaps: let(steps(values, gaps),
                                                   lambda n: let(running(n), lambda at: places(values, gaps, at)))))


def plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def emails(text: Column) -> Column:
    """Around every @: the longest local part that no earlier match holds, and
    labels joined by single dots, two at least."""
    pieces = F.split(text, "@", -1)

    def parts(p: Column) -> Column:
        run = F.regexp_extract(p, r"^[A-Za-z0-9.-]*+", 0)
        cut = F.rtrim(F.substring_index(run, "..", 1), F.lit("."))
        domain = let(cut, lambda c: F.when(~c.startswith(".") & c.contains("."), F.length(c)).otherwise(0))
        return F.struct(F.length(p).alias("size"),
                        F.length(F.regexp_extract(p, rf"(?<![{LOCAL}])[{LOCAL}]++\z", 0)).alias("local"),
                        domain.alias("domain"))

    start = lambda info: F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("used"), F.element_at(info, 1).alias("last"),
        empty("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        sign = acc["at"] + acc["last"]["size"]            # place of this @
        local = F.least(acc["last"]["local"], acc["last"]["size"] - acc["used"])
        hit = (local > 0) & (x["domain"] > 0)
        return F.struct(
            (sign + 1).alias("at"), F.when(hit, x["domain"]).otherwise(0).alias("used"), x.alias("last"),
            F.when(hit, F.concat(acc["out"], F.array(F.struct(
                (sign - local).alias("start"), (sign + 1 + x["domain"]).alias("end"))))).otherwise(acc["out"]).alias("out"))

    found = let(F.transform(pieces, parts), lambda info: F.aggregate(
        F.slice(info, F.lit(2), F.size(info)), start(info), step, lambda acc: acc["out"]))
    return F.when(F.instr(text, "@") > 0, found).otherwise(empty("array<struct<start:int,end:int>>"))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    d = F.reverse(digits(value))
    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda acc, k: acc + F.when(
        k % 2 == 0, (F.substr(d, k, F.lit(1)).cast("int") * 2) % 10
        + F.floor(F.substr(d, k, F.lit(1)).cast("int") * 2 / 10).cast("int")
    ).otherwise(F.substr(d, k, F.lit(1)).cast("int")))
    return total % 10 == 0


def octets(value: Column) -> Column:
    """Four parts of at most 255; the parts may have any number of leading zeros."""
    return F.forall(F.split(value, r"\."), lambda p: F.rlike(p, F.lit(r"^0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$|^0+$")))


FEATURES = ("length", "digits", "groups", "longest", "spaces", "dots", "dashes", "brackets", "plus", "letter_before",
            "letter_after", "keyword", "written", "at_marked", "dot_marked", "known_end")


def features(s: Column, generator: int) -> Column:
    v = s["value"]
    groups = F.regexp_extract_all(v, F.lit("([0-9]++)"), F.lit(1))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    count = lambda chars: F.length(F.regexp_replace(v, f"[^{chars}]", "")).cast("double")
    has = lambda c, pattern: F.coalesce(F.rlike(F.lower(c), F.lit(pattern)), F.lit(False))
    if generator:
        at, dot, end = has(v, r"[\[(]at[\])]"), has(v, r"[\[(]dot[\])]"), has(v, r"[^a-z]" + TOP_LEVEL)
        end = end | has(v, r"[^a-z]dot" + TOP_LEVEL)
        certain = end & (at | dot | has(s["before"], MAILED))
    else:
        at = dot = end = F.lit(False)
        n = F.length(digits(v))
        certain = (~has(v, DATE) & ~has(s["after"], "^[a-z0-9]")
                   & (n.between(7, 15) & has(s["before"], CALLED) | n.between(8, 19) & has(s["before"], NUMBERED)))
    return F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(generator).alias("generator"),
        F.length(v).cast("double").alias("length"), count("0-9").alias("digits"),
        F.size(groups).cast("double").alias("groups"),
        F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)).cast("double").alias("longest"),
        count(" ").alias("spaces"), count(".").alias("dots"), count(r"\-").alias("dashes"),
        count("()").alias("brackets"), flag(F.rlike(s["before"], F.lit(r"\+ ?$"))).alias("plus"),
        flag(F.rlike(s["before"], F.lit("[A-Za-z]$"))).alias("letter_before"),
        flag(F.rlike(s["after"], F.lit("^[A-Za-z]"))).alias("letter_after"),
        flag(F.rlike(F.lower(s["before"]), F.lit(KEYWORDS))).alias("keyword"),
        F.lit(float(generator)).alias("written"), flag(at).alias("at_marked"), flag(dot).alias("dot_marked"),
        flag(end).alias("known_end"), certain.alias("certain"))


def proposals(docs: DataFrame) -> DataFrame:
    """doc_id, spans of each base kind, and all proposals with their features."""
    text = F.col("text")
    none = empty(SPAN)
    numeric = F.rlike(text, F.lit("[0-9]"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = rows.select(
        "doc_id", F.xxhash64("doc_id", "text").alias("key"), emails(text).alias("email"),
        plain(F.filter(F.when(numeric, located(text, IP)).otherwise(none), lambda s: octets(s["value"]))).alias("ip"),
        plain(F.filter(F.when(numeric, located(text, CARD)).otherwise(none), lambda s: luhn(s["value"]))).alias("card"),
        plain(F.filter(F.when(F.instr(text, "+") > 0, located(text, PHONE)).otherwise(none),
                       lambda s: F.length(digits(s["value"])).between(8, 15))).alias("phone"),
        F.concat(
            F.transform(F.when(numeric, located(text, NUMBER)).otherwise(none), lambda s: features(s, 0)),
            F.transform(F.when(F.rlike(text, F.lit(WRITTEN_OUT)), located(text, "(?i)" + ADDRESS)).otherwise(none),
                        lambda s: features(s, 1))).alias("proposed"))
    base = F.concat(*[F.col(k) for k in BASE_KINDS])
    hit = lambda held, p: F.exists(held, lambda b: (b["start"] < p["end"]) & (p["start"] < b["end"]))
    found = found.withColumn("proposed", let(base, lambda held: F.transform(
        F.col("proposed"), lambda p: p.withField("held", hit(held, p)))))
    # a base span beside a written-out address says nothing about it
    return found.withColumn("proposed", F.transform("proposed", lambda p: p.withField(
        "label", (p["certain"] | (p["held"] & (p["generator"] == 0))).cast("double"))))


def tree_expression(node, value) -> Column:
    """A fitted tree as a SQL expression over ``value(feature name)``."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(value(FEATURES[split.featureIndex()]) <= split.threshold(),
                  tree_expression(node.leftChild(), value)).otherwise(tree_expression(node.rightChild(), value))


def fit(found: DataFrame):
    """(score of a proposal as a function to a Column, {generator: threshold}), or None."""
    rows = found.select("key", F.explode("proposed").alias("p")).select("key", "p.*")
    every = F.lit(1).cast("long")
    for r in rows.groupBy("generator", "label").count().collect():
        every = F.when((F.col("generator") == r["generator"]) & (F.col("label") == r["label"]),
                       F.lit(max(1, r["count"] // CELL_ROWS)).cast("long")).otherwise(every)
    # a quarter of the texts is never fitted on, so small tables have rows to calibrate on as well
    drawn = (F.pmod(F.xxhash64("key", F.lit(7)), F.lit(4)) > 0) & (F.pmod(F.xxhash64("key", "start"), every) == 0)
    # rows that repeat a text count once, so they don't break the bound
    sample = stored(rows.where(drawn).dropDuplicates(["key", "generator", "start"]).coalesce(4), "pii-sample")
    seen = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    if len(seen) < 2:           # one label alone says nothing about the other
        return None
    learn = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7).fit(learn)
    roots = [t._java_obj.rootNode() if hasattr(t, "_java_obj") else t._call_java("rootNode") for t in model.trees]

    def score(value) -> Column:
        trees = [F.lit(float(w)) * tree_expression(r, value) for w, r in zip(model.treeWeights, roots)]
        return 1 / (1 + F.exp(-2 * sum(trees[1:], trees[0])))

    held = rows.where(~drawn).select("generator", "label", F.floor(score(F.col) * 100).alias("bin"))
    bins = held.groupBy("generator", "bin").agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect()
    limits = {}
    for generator in (0, 1):
        good = n = 0
        for row in sorted((r for r in bins if r["generator"] == generator), key=lambda r: -r["bin"]):
            good, n = good + row["good"], n + row["n"]
            # the expected share of good ones after what was seen (rule of succession)
            if (good + 1) / (n + 2) >= PRECISION:
                limits[generator] = row["bin"] / 100
    return score, limits


def find_personal(docs: DataFrame) -> DataFrame:
    found = stored(proposals(docs), "pii")
    fitted = fit(found)
    score, limits = fitted or (None, {})

    def added(generator: int) -> Column:
        def chosen(p: Column) -> Column:
            like = F.lit(False)
            if generator in limits:
                like = score(lambda name: p[name]) >= limits[generator]
            # what a base span holds already is not reported twice
            return (p["generator"] == generator) & ~p["held"] & (p["certain"] | like)
        return plain(F.filter("proposed", chosen))

    written = added(1)
    numbers = let(written, lambda held: F.filter(
        added(0), lambda p: ~F.exists(held, lambda w: (w["start"] < p["end"]) & (p["start"] < w["end"]))))
    listed = {**{k: F.col(k) for k in BASE_KINDS}, "number": numbers, "address": written}
    as_text = lambda kind: F.transform(F.array_sort(listed[kind]), lambda s: F.concat_ws(
        ":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(F.array_join(F.concat(*[as_text(k) for k in BASE_KINDS]), ","), 256).alias("base_sha256"),
        F.array_join(F.concat(*[as_text(k) for k in KINDS]), ",").alias("spans"),
        (F.size(numbers) + F.size(written)).cast("long").alias("n_added"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal(documents(spark, sf_dir))
