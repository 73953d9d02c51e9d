"""Anchor expansion against the plain regular expressions."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkspark.llm import pii_anchors as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and P.luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


PIECES = st.sampled_from(["a", "Z", "é", "7", "0", "4111", "1111", "255", "256", "3", ".", "-", " ", "@", "@@", "+", "(", ")", "_", "%",
                          "x@y.z", "1.2.3.4", "4111 1111 1111 1111", "+1 (555) 123-4567", "\n", "iban", "account ", "://"])


@settings(max_examples=1500, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join))
def test_base_spans_equal_the_patterns(text):
    assert [s for s in P.find(text) if s[0] in P.BASE_KINDS] == brute(text)


def test_added_spans():
    found = P.find("IBAN: DE89 3704 0044 0532 0130 00 und Konto Nr. 12345678, see ftp://me:pw@host.example/x; accounts 1234567")
    assert [(k, e - s) for k, s, e in found if k not in P.BASE_KINDS] == [("iban", 27), ("account", 8), ("login", len("ftp://me:pw@host.example"))]


@pytest.mark.parametrize("text, number", [
    ("Customer ID: 12345678", "12345678"), ("İ cUSTOMER iD 12345678", "12345678"), ("PassPort No. X1234567", "X1234567"),
    ("Account: 1234 5678 9012", "1234 5678 9012"), ("account number is 12345678", "12345678"), ("Account is: DE12 3456, then", "DE12 3456"),
    ("account is-12345678", "is-12345678"), ("account 12345678 9th", "12345678"), ("account 1234567  89", "1234567"),
    ("account 1234567 " + "8" * 50, "1234567"), ("account 123 456 " + "7 " * 28 + "x", ("123 456 " + "7 " * 28).strip())])
def test_accounts_in_any_spelling(text, number):
    at = text.index(number)
    assert [s for s in P.find(text) if s[0] == "account"] == [("account", at, at + len(number))]


def test_iban_in_any_spelling():
    assert [s[0] for s in P.find("Your iBan is DE89 3704 0044 0532 0130 00")][-1] == "iban"


def test_long_runs_are_linear():
    for text in ("1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" * 150_000, "a" * 300_000 + "@", "iban " * 60_000):
        P.find(text)


def test_redaction_covers_every_span():
    text = "mail joe@x.org or +1 (555) 123-4567 é 10.0.0.1"
    assert P.redacted(text, P.find(text)) == "mail <EMAIL> or <PHONE> é <IP>"


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(1, None, "x"), (2, "", "x"), (3, "é joe@x.org", "x"), (3, "é joe@x.org", "x"), (None, "4111 1111 1111 1111", None)]
    for name, data in (("some", rows), ("none", [])):
        df = spark.createDataFrame(data, "doc_id long, text string, spans string")
        df.write.parquet(str(tmp_path / name / "documents.parquet"))
        got = P.op9_pii_anchor_expansion(spark, str(tmp_path / name)).collect()
        assert len(got) == len(data)
        for r in got:
            text = {1: "", 2: "", 3: "é joe@x.org", None: "4111 1111 1111 1111"}[r.doc_id]
            line = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(text))
            assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest() and r.spans == line
    kept = P.redact(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    assert sorted(str(r.text) for r in kept) == ["", "<CARD>", "None", "é <EMAIL>", "é <EMAIL>"] and kept[0].spans == "x"
