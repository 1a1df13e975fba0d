import base64
import hashlib
import json
import re

from tests.llm.cases import ODD, SF, empty_documents, odd_documents, table
from tidemark.llm import secrets as S


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x81, n]) if n < 256 else b"\x82" + n.to_bytes(2, "big")
    return bytes([tag]) + size + body


def integer(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


RSA = der(0x30, b"".join([integer(0), integer((1 << 511) + 9), integer(65537), *[integer((1 << 250) + k) for k in range(6)]]))
EC = der(0x30, integer(1) + der(4, b"k" * 32))
PKCS8 = der(0x30, integer(0) + der(0x30, der(6, b"\x2a\x86\x48")) + der(4, RSA))


def b64(data):
    return base64.b64encode(data).decode()


def url(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


JWT = url(b'{"alg":"HS256","typ":"JWT"}') + "." + url(b'{"sub":"x","n":1}') + "." + url(b"s" * 32)
SSH = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) \
    + (1).to_bytes(4, "big") + (51).to_bytes(4, "big") + b"p" * 51


def kinds(text):
    return [(k, text[a:b]) for k, a, b in S.confirmed_spans(text)]


def test_structures():
    assert kinds(f"key {b64(RSA)} end") == [("der", b64(RSA))]
    assert kinds(f"key {b64(PKCS8)}") == [("der", b64(PKCS8))]
    assert kinds(f"x {EC.hex()} y") == [("der", EC.hex())]
    assert kinds(f"x {b64(SSH)} y") == [("ssh", b64(SSH))]
    assert kinds(f"Bearer {JWT}, ok") == [("jwt", JWT)]
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{b64(RSA)[:64]}\n{b64(RSA)[64:]}\n-----END RSA PRIVATE KEY-----"
    assert kinds(f"a {pem} b") == [("pem", pem)]


def test_what_lacks_structure_is_not_reported():
    bad = RSA[:10] + b"\x05" + RSA[11:]
    for text in (b64(b"q" * 90), b64(RSA[:-1]), b64(bad[:40] + b"\xff" + bad[41:])[:-8], "eyJhbGciOiJ4.eyJ4.abc",
                 url(json.dumps({"a": 1}).encode()) + ".e30.c2ln", "-----BEGIN RSA PRIVATE KEY-----\nabc",
                 "-----BEGIN CERTIFICATE-----\n" + b64(b"q" * 99) + "\n-----END CERTIFICATE-----", "0" * 5000, "eyJ" * 3000):
        assert kinds(text) == [], text[:60]


def base(text):
    low = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [("assign", m.start(), m.end()) for m in low.finditer(text)
           if len(m[2]) >= 8 and m[1].isascii()]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    order = ["assign", "access", "hex"]
    return sorted(out, key=lambda x: (x[1], order.index(x[0])))


def expected(rows):
    out = []
    for doc_id, text in rows:
        spans = base(text or "")
        out.append((doc_id, *[sum(k == x for k, _, _ in spans) for x in ("assign", "access", "hex")],
                    hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256").collect()), key=str)


def test_base_spans(spark):
    more = [(20, f"API_KEY: 'abcdefgh12' token=x secret = {'f' * 40} AKIAAKIAAKIA1234567 AKIA12 ſecret=abcdefgh12"),
            (21, f"pass {JWT} then {b64(RSA)}")]
    df = S.scan_secrets(odd_documents(spark, ODD + more))
    assert found(df) == expected(ODD + more)
    assert df.where("doc_id = 21").first()["spans"] == f"jwt:5:{5 + len(JWT)},der:{11 + len(JWT)}:{11 + len(JWT) + len(b64(RSA))}"
    assert found(S.scan_secrets(empty_documents(spark))) == []


def test_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(SF, "documents")]
    assert found(S.op2_secret_scan(spark, SF)) == expected(rows)


def test_heads_with_white_space_and_before_other_words():
    code = lambda x: base64.urlsafe_b64encode(x.encode()).decode().rstrip("=")
    token = f"{code('{ \"alg\": \"HS256\" }')}.{code('{\"sub\": 1}')}.{'c2lnbmF0dXJl' * 3}"
    assert not token.startswith("eyJ")
    for before in ("", "Authorization.", "see example-host.longer-name.", "a" * 50 + "."):
        assert [("jwt", len(before), len(before) + len(token))] == [s for s in S.confirmed_spans(before + token) if s[0] == "jwt"]


def test_thousands_of_tokens_take_linear_time():
    import time
    code = lambda x: base64.urlsafe_b64encode(x.encode()).decode().rstrip("=")
    token = f"{code('{\"alg\":\"HS256\"}')}.{code('{\"sub\":1}')}.c2lnbmF0dXJlc2lnbmF0dXJlc2lnbmF0dXJlc2lnbmF0dXJl"
    times = []
    for n in (3000, 24_000):
        text, began = f"{token} " * n, time.perf_counter()
        assert len(S.confirmed_spans(text)) == n
        times.append(time.perf_counter() - began)
    assert times[1] < 30 * times[0]
