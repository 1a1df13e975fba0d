import hashlib
import random
import re

from tests.llm.cases import ODD, SF, empty_documents, odd_documents, table
from tidemark.llm import pii as D

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(int(c) if k % 2 == 0 else int(c) * 2 // 10 + int(c) * 2 % 10 for k, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def expected(rows):
    out = []
    for doc_id, text in rows:
        spans = base(text or "")
        out.append((doc_id, *[sum(k == x for k, _, _ in spans) for x in D.BASE_KINDS],
                    hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256").collect()), key=str)


def test_odd_rows(spark):
    assert found(D.find_personal(odd_documents(spark))) == expected(ODD)
    assert found(D.find_personal(empty_documents(spark))) == []


def test_random_texts(spark):
    rng = random.Random(5)
    parts = ["a", "b.", "@", ".", "1", "23", "-", " ", "+", "(", ")", "é", "😀", "\n", "4111 1111 1111 1111",
             "192.168.0.1", "x@y.org", "..", "_", "%", "000", "255", "+1 (555) 010-9999", "5500-0000-0000-0004", "0"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for k in range(1500)]
    rows += [(9000 + k, t) for k, t in enumerate([
        "a@" + "b." * 5000, "1 " * 5000, "1" * 5000, "a@b.co " * 2000, "+1" * 5000, "1." * 5000, "x" * 5000 + "@",
        "0000001.2.3.0255", "a@b.c@d.e@f.g@h.i", "256.1.1.1.1", "a@b\n", "a@.b.c", "a@b..c"])]
    assert found(D.find_personal(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


def test_boosted_trees_add_spans_like_the_labelled_ones(spark):
    """A number of the form of the labelled ones, but outside the base pattern."""
    rng = random.Random(2)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = []
    for k in range(1200):
        rows.append((2 * k, f"my phone +1 ({digits(3)}) {digits(3)}-{digits(4)} thanks"))
        rows.append((2 * k + 1, f"the order {digits(4)} {digits(4)} {digits(3)} came"))
    rows.append((9001, "my phone + 1 (212) 555-0188 thanks"))
    rows.append((9002, "the order 1234 5678 901 came"))
    got = {r.doc_id: r for r in D.find_personal(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[9001].spans == "number:11:27" and got[9001].n_added == 1
    assert got[9002].spans == "" and got[0].spans.startswith("phone:9:")
    assert sum(r.n_added for r in got.values()) == 1


def spans_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.spans for r in sorted(D.find_personal(df).collect(), key=lambda r: r.doc_id)]


def test_certain_proposals_of_each_generator(spark):
    """On a table too small for the trees as well."""
    assert spans_of(spark, [
        "write to john (at) host dot org soon", "jane[AT]mail[dot]host.co[dot]uk", "mail: bo at host dot com",
        "tel. 555-123-4567 now", "call me at (030) 1234567", "my account number is 1234 567 890",
        "look at host dot com", "john (at) host dot nothing", "hotel 5551234567", "call 2019-12-11", "contact 2018-2020",
        "the order 555-123-4567", "jo@host.org tel 555-123-4567"]) == [
        "address:9:31", "address:0:31", "address:6:24", "number:5:17", "number:11:24", "number:21:33",
        "", "", "", "", "", "", "email:0:11,number:16:28"]


def test_boosted_trees_select_written_out_addresses(spark):
    """Generator 1 gets a threshold by addresses alone, none of them near an e-mail."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghik") for _ in range(rng.randint(4, 9)))
    texts = [t for _ in range(600) for t in (f"say {word()} (at) {word()} dot org to", f"so {word()} at {word()} dot zzq to")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, limits = D.fit(D.proposals(df))
    assert 1 in limits
    got = {r.doc_id: r for r in D.find_personal(df).collect()}
    assert all(r.n_added == (k % 2 == 0) for k, r in got.items())


def test_a_rare_generator_keeps_its_threshold(spark, monkeypatch):
    """However many numbers there are, addresses are sampled and calibrated by themselves."""
    monkeypatch.setattr(D, "CELL_ROWS", 100)
    texts = [f"mail to {'abcdefgh'[k % 8] * (3 + k % 7)}{k} (at) host dot org" for k in range(80)]
    texts += [f"+49 {k:04d} 5550{k % 10} and {k:05d}-{k % 9}{k % 7} so" for k in range(4000)]
    df = spark.createDataFrame([(None if k % 3 else k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    _, limits = D.fit(D.proposals(df))
    assert 1 in limits


def test_main_path_has_no_python(spark, capsys):
    D.proposals(spark.read.parquet(f"{SF}/documents.parquet")).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_documents(spark):
    assert found(D.op10_pii(spark, SF)) == expected([(r["doc_id"], r["text"]) for r in table(SF, "documents")])
