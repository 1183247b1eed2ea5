from __future__ import annotations

import datetime as dt
import hashlib
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import pii, secrets
from strata.llm.common import table
from tests.llm.conftest import docs_of

SF = "/root/testdata/sf0.01"
KEY = "test key"


def plain_base(text):
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    )
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


pieces = st.sampled_from(
    ["token", "secret", "Password", "passwd", "api_key", "APIKEY", ": ", "=", " ", '"', "'", "abc", "abcdef", "AKIA", "A1B2C3D4E5F6G7H8",
     "0123456789abcdef", "é", "İ", "ſecret", "K", "\n", "tokentoken", "-", "."]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(pieces, max_size=14).map("".join))
def test_base_spans_match_plain_expressions(text):
    assert [s for s in secrets.scan(text, secrets.keyword_automaton()) if s[1] < 3] == plain_base(text)


def token(prefix, body):
    digits, value = "", zlib.crc32(body.encode())
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"[rest] + digits
    return prefix + body + digits


def test_checksummed_tokens():
    good = token("ghp_", "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5")
    found = secrets.scan(f"x {good} y", secrets.keyword_automaton())
    assert [(a, secrets.KINDS[k], b) for a, k, b in found] == [(2, "github", 42)]
    assert not secrets.scan(good[:-1] + ("0" if good[-1] != "0" else "1"), secrets.keyword_automaton())
    assert secrets.scan(token("npm_", "Z" * 30), secrets.keyword_automaton())


def test_scan_of_documents_and_edges(spark, edge_docs, no_docs):
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    hits = 0
    for r in secrets.scan_secrets(docs).collect():
        spans = plain_base(texts[r.doc_id])
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert r.spans == text or r.n_checksum
        hits += len(spans)
    assert hits
    got = secrets.scan_secrets(edge_docs).collect()
    assert len(got) == edge_docs.count()
    assert {r.base_sha256 for r in got if r.doc_id in (1, 2)} == {hashlib.sha256(b"").hexdigest()}
    assert secrets.scan_secrets(no_docs).count() == 0


# --- pseudonyms ---------------------------------------------------------------


def feistel(symbols, radices, kind):
    state = list(symbols)
    for t in range(pii.ROUNDS):
        still = [str(x) for i, x in enumerate(state) if (i + t) % 2]
        digest = hashlib.sha512("|".join([KEY, kind, str(t), str(len(state)), ",".join(still)]).encode()).hexdigest()
        state = [
            x if (i + t) % 2 else (x + int(digest[i // 2 * 4 : i // 2 * 4 + 4], 16)) % radices[i]
            for i, x in enumerate(state)
        ]
    return state


def plain_text(text, kind):
    base = [next(((ord(c) - ord(a), n, a) for a, n in (("0", 10), ("a", 26), ("A", 26)) if a <= c < chr(ord(a) + n)), None) for c in text]
    mixed = feistel([b[0] if b else 0 for b in base], [b[1] if b else 1 for b in base], kind)
    return "".join(chr(ord(b[2]) + s) if b else c for b, s, c in zip(base, mixed, text, strict=True))


def refill(shape, digits):
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in shape)


def luhn(digits):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed([int(c) for c in digits]))) % 10


def plain(value, kind):
    digits = "".join(c for c in value if c.isdigit())
    if kind == "email":
        local, _, domain = value.partition("@")
        return plain_text(local, kind) + "@" + domain
    if kind == "phone":
        country = re.match(r"^(\+[0-9]{1,3}(?=[ .(-])[ .-]?)?", value)[0]
        if value[0] == "0" and not re.match(r"[0-9]{3}[ .-][0-9]{3}[ .-]", value):
            country = "0"
        rest = value[len(country) :]
        return country + refill(rest, plain_text("".join(c for c in rest if c.isdigit()), kind))
    if kind == "card":
        body = plain_text(digits[:-1], kind)
        last = next(str(d) for d in range(10) if luhn(body + str(d)) == luhn(digits))
        return refill(value, body + last)
    if kind == "ip":
        return ".".join(map(str, feistel([int(x) for x in value.split(".")], [256] * 4, kind)))
    if kind == "ssn":
        a, g, s = map(int, value.split("-"))
        a, g, s = feistel([a - 1 - (a > 666), g - 1, s - 1], [898, 99, 9999], kind)
        return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{s + 1:04d}"
    shape = "%d.%m.%Y" if "." in value else "%m/%d/%Y" if value[2] == "/" else "%Y/%m/%d" if "/" in value else "%Y-%m-%d"
    day = (dt.datetime.strptime(value, shape).date() - dt.date(1904, 1, 1)).days
    high, low = feistel(divmod(day, 487), [147, 487], kind)
    return (dt.date(1904, 1, 1) + dt.timedelta(high * 487 + low)).strftime(shape)


VALUES = {
    "email": ["ann.34@mail7.example.com", "Été.9_x@a-b.co.uk", "x@y.org"],
    "phone": ["+1 (017) 555-7713", "555 123 4567", "(555)123-4567", "+44-555.123.4567", "+49 30 1234567", "+44 20 7946 0958", "020 7946 0958", "0161-496-0000", "017 555-7713"],
    "card": ["4785380592391139", "378282246310005", "3782 822463 10005", "3782-822463-10005", "4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004"],
    "ip": ["1.43.173.185", "255.255.255.255", "0.0.0.0"],
    "ssn": ["123-45-6789", "665-01-0001", "667-99-9999", "899-10-1000"],
    "date": ["2024-02-29", "1904-01-01", "2099/12/31", "31.12.1999", "03/31/1990"],
}


def test_pseudonyms_match_plain_version(spark):
    values = [(k, v) for k, vs in VALUES.items() for v in vs]
    got = pii.pseudonymise(docs_of(spark, [f"see {v}, or ({v})!" for _, v in values]), KEY).orderBy("doc_id").collect()
    for r, (kind, value) in zip(got, values, strict=True):
        new = plain(value, kind)
        assert r.text == f"see {new}, or ({new})!", (kind, value)
        assert r[f"n_{kind}"] == 2 and sum(r[f"n_{k}"] for k in pii.KINDS) == 2
        if kind == "card":
            assert luhn(re.sub(r"\D", "", new)) == luhn(re.sub(r"\D", "", value)) == 0


def test_permutations_are_one_to_one(spark):
    dates = [(dt.date(1904, 1, 1) + dt.timedelta(k * 7)).isoformat() for k in range(10_000)]
    got = pii.pseudonymise(docs_of(spark, dates), KEY).select("text").collect()
    assert len({r.text for r in got}) == len(dates) and all("1904" <= r.text[:4] <= "2099" for r in got)


def test_what_is_not_personal_data_stays(spark):
    texts = ["2023-02-30", "999.1.1.1", "000-12-3456", "version 3.14, 12345678901234567890123", "a @ b", "", "1999-1-1", "$1 \\1 [x] 12", "9804bc4785380592391139ffd", "x4785380592391139"]
    got = pii.pseudonymise(docs_of(spark, texts), KEY).orderBy("doc_id").collect()
    assert [r.text for r in got] == texts
    assert all(r[f"n_{k}"] == 0 for r in got for k in pii.KINDS)


def test_numbers_without_a_right_luhn_sum_are_no_cards(spark):
    texts = ["order 1234567890123 stamp 1700000000000", "4111 1111 1111 1112", "4111111111111111 and 4111111111111112", "3782 822463 10006"]
    got = pii.pseudonymise(docs_of(spark, texts), KEY).orderBy("doc_id").collect()
    assert [r.text for r in got] == [*texts[:2], f"{plain('4111111111111111', 'card')} and 4111111111111112", texts[3]]
    assert [(r.n_card, r.n_rejected) for r in got] == [(0, 2), (0, 1), (1, 1), (0, 1)]
    short = ["+1 23 45", "+12 12345678 12345678", "13/31/1990", "02/30/2001"]
    got = pii.pseudonymise(docs_of(spark, short), KEY).orderBy("doc_id").collect()
    assert [r.text for r in got] == short and all(r[f"n_{k}"] == 0 for r in got for k in (*pii.KINDS, "rejected"))


def test_pii_edges(spark, edge_docs, no_docs):
    got = pii.pseudonymise(edge_docs, KEY)
    assert got.columns == ["doc_id", "text", *(f"n_{k}" for k in pii.KINDS), "n_rejected"]
    same = edge_docs.select("doc_id", "text").exceptAll(got.select("doc_id", "text"))
    assert same.count() == 0 and got.count() == edge_docs.count()
    assert pii.pseudonymise(no_docs, KEY).count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
