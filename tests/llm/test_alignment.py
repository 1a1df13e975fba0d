import hashlib
from collections import Counter

import public_tokenizers as P
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from tests.llm.cases import ODD, SF, empty_documents, odd_documents, table
from tidemark.llm import alignment as A

FILES = str(P.path(A.BYTE_TOKENIZER)), str(P.path(A.PIECE_TOKENIZER))


def tokens(text):
    """[(id, start, end)] of both sides, or two empty lists."""
    import sentencepiece
    from tokenizers import Tokenizer
    if not hasattr(tokens, "first"):
        tokens.first, tokens.second = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
        tokens.first.encode_special_tokens = True
        tokens.names = {k: v for v, k in tokens.first.get_vocab().items()}
    if not text:
        return [], []
    alphabet = A._byte_alphabet()
    first = [(i, bytes(alphabet[c] for c in tokens.names[i])) for i in tokens.first.encode(" " + text, add_special_tokens=False).ids]
    second = []
    for i in tokens.second.encode(text):
        piece = tokens.second.id_to_piece(i)
        second.append((i, bytes([int(piece[3:5], 16)]) if tokens.second.is_byte(i) else piece.replace("▁", " ").encode()))
    if any(b"".join(x for _, x in side) != (" " + text).encode() for side in (first, second)):
        return [], []
    out = []
    for side in (first, second):
        at, spans = 0, []
        for i, x in side:
            spans.append((i, at, at + len(x)))
            at += len(x)
        out.append(spans)
    return out


def brute(texts):
    links, rows = [], []
    for text in texts:
        a, b = tokens(text)
        pairs = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, lo = [], 0
        for hi in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if lo <= s and e <= hi) for side in (a, b)))
            lo = hi
        links.append(pairs)
        rows.append([len(a), len(b), len(groups), len(pairs), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""])
    count = Counter(p for pairs in links for p in set(pairs))
    top = Counter()
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    return [(*r[:4], sum(count[p] == top[p[0]] for p in pairs), sum(count[p] for p in pairs), r[4]) for r, pairs in zip(rows, links)]


def answer(df):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
                   r.groups_sha256) for r in df.collect())


STRANGE = ["  two  spaces ", "tab\there\n\nnl", "▁under", "<0x41><s></s><|endoftext|>", " ", "\x00a", "é ﬁ \xa0x 　",
           "日本語のテキスト", "\U0001F600\U0001F600", "a" * 3000, "don't 12,345.67 é", "x ▁ y", "\r\n"]


def test_rows_equal_brute_force(spark, monkeypatch):
    texts = [r["text"] for r in table(SF, "documents")][:60]
    rows = [(k, t[:2500] if t else t) for k, t in enumerate(texts)] + [(1000 + k, t) for k, t in enumerate(STRANGE)]
    rows += [r for r in ODD if r[1] is None or len(r[1]) < 3000]
    docs = odd_documents(spark, rows)
    want = sorted((i is not None, i or 0, *x) for (i, _), x in zip(rows, brute([t for _, t in rows])))
    assert answer(A.alignment(docs, byte_tokenizer=FILES[0], piece_tokenizer=FILES[1])) == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" ab.,'1é\n\t▁<>日\u3000\u1680\x1c\x85\xa0²"), st.characters(codec="utf-8")),
                        max_size=40), max_size=6))
def test_ids_of_units_are_those_of_the_whole_text(texts):
    pair = A.pair_of(*FILES)
    assert pair.cuts
    for _ in range(2):          # learned, then remembered
        got = [x.to_pylist() for x in pair.encode(texts)]
        assert got[0] == [pair.first.encode(" " + t, add_special_tokens=False).ids if t else [] for t in texts]
        assert got[1] == [pair.second.encode(t) if t else [] for t in texts]


def test_units_with_white_space_at_their_ends():
    texts = ["abc\n", "\n\ndef", " \t x", "abc  ", "  def", "a \n", "\n b c \n\n", "x\u3000", "\u3000y"]
    pair = A.Pair(*FILES)
    assert pair.encode(texts)[0].to_pylist() == [pair.first.encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert pair.encode(texts)[1].to_pylist() == [pair.second.encode(t) for t in texts]


def test_documents_are_encoded_as_whole_texts(monkeypatch):
    monkeypatch.setattr(A, "JOIN_CHARS", 300)
    monkeypatch.setattr(A, "CACHE_UNITS", 500)
    texts = [r["text"] for r in table(SF, "documents") if r["text"]]
    pair = A.Pair(*FILES)
    for lo in range(0, len(texts), 25):
        got = [x.to_pylist() for x in pair.encode(texts[lo:lo + 25])]
        assert got[0] == [e.ids for e in pair.first.encode_batch([" " + t for t in texts[lo:lo + 25]], add_special_tokens=False)]
        assert got[1] == pair.second.encode(texts[lo:lo + 25])


def test_links_are_the_overlaps_of_one_text():
    text = "the unbelievable\n\tstory"
    per_doc, held = A.align(A.pair_of(*FILES), pa.array([None, text, ""]))
    a, b = tokens(text)
    want = Counter((x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2])
    assert {(r["a"], r["b"]): r["occ"] for r in held.to_pylist()} == want and set(held["doc"].to_pylist()) == {1}
    assert per_doc["n_a"].to_pylist() == [0, len(a), 0] and per_doc["groups"].to_pylist()[::2] == [None, None]


def test_empty_table(spark):
    df = A.alignment(empty_documents(spark), byte_tokenizer=FILES[0], piece_tokenizer=FILES[1])
    assert df.collect() == [] and df.columns[-1] == "groups_sha256"


def test_registered_query_answers_every_document(spark):
    got = E.queries()["op13_token_alignment"](spark, SF)
    docs = table(SF, "documents")
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == len(docs)
    short = [d for d in docs if d["text"] and len(d["text"]) < 2000][:10]
    for d, want in zip(short, brute([d["text"] for d in short])):
        r = rows[d["doc_id"]]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (*want[:4], want[6])
