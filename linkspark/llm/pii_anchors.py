"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, ``://`` and identifier
cues.  At each anchor a local parser expands to the boundaries of a candidate and validates it, so the
work is linear in the text and nothing is tried at other places.

Base kinds (leftmost, non-overlapping within a kind; a candidate that fails its check is consumed):
email, ip (parts at most 255), card (13 to 19 digits, Luhn), phone (9 to 15 digits).  Added kinds: iban
(cue, then a number that passes mod 97), account (cue, then an identifier of 6 to 34 characters with at
least 5 digits, groups of digits parted by single spaces not counting those), login
(``scheme://user:password@host``).  Cues count in any case.  Spans are code points, end exclusive.

Defined cases: a null text has no spans; repeated rows are treated alike; an empty table gives an empty
result; only ``doc_id`` and ``text`` are read, ``redact`` keeps every other column.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkspark.llm.common import read

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "account", "login")
CUES = ("account", "acct", "konto", "kontonummer", "cuenta", "compte", "passport", "ssn", "customer id")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789.+-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_RUN = re.compile(r"[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_FILLER = re.compile(r"(?:[ \t]*+(?:no|nr|number|num|id|n°)\b\.?)?(?:[ \t]*+is(?=[ \t:=#]))?[ \t]*+[:=#]?[ \t]*+", re.I)
_IDENT = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9]|-(?=[A-Za-z0-9])|(?<=[0-9]) (?=[0-9]++(?![A-Za-z]))[0-9]){5,33}(?![A-Za-z0-9-])")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_LOGIN = re.compile(r"[^\s/@:]+:[^\s/@]+@[A-Za-z0-9.-]+")


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for digit in "0123456789":
        a.add_word(digit, ("number", 1))
    for mark, kind in (("@", "email"), ("+", "phone"), ("://", "login")):
        a.add_word(mark, (kind, len(mark)))
    for cue, kind in [("iban", "iban"), *((c, "account") for c in CUES)]:
        a.add_word(cue, (kind, len(cue)))
    a.make_automaton()
    return a


def ascii_lower(text: str) -> str:
    """``text`` with A to Z in lower case and every other character, and so every place, as it was."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_ok(number: str) -> bool:
    return 15 <= len(number) <= 34 and int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans of ``text`` as ``(kind, start, end)``, by kind as in ``KINDS``, then start."""
    found: dict[str, list[tuple[str, int, int]]] = {k: [] for k in KINDS}
    past = dict.fromkeys(("email", "ip", "card", "phone", "run", "iban", "account", "login"), 0)

    def add(kind: str, start: int, end: int) -> None:
        found[kind].append((kind, start, end))
        past[kind] = end

    for last, (kind, width) in automaton().iter(ascii_lower(text)):
        at, after = last - width + 1, last + 1
        if kind == "number":
            if at >= past["run"]:  # the first digit of a run
                past["run"] = _RUN.match(text, at).end()
                if at >= past["ip"] and (m := _IP.match(text, at)):
                    past["ip"] = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.groups()):
                        found["ip"].append(("ip", at, m.end()))
                if at >= past["card"] and (m := _CARD.match(text, at)):
                    past["card"] = m.end()
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append(("card", at, m.end()))
        elif kind == "email":
            start = at
            while start > past["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, after)):
                add("email", start, m.end())
        elif kind == "phone":
            if at >= past["phone"] and (m := _PHONE.match(text, at)):
                past["phone"] = m.end()
                if 9 <= sum(c in _DIGITS for c in m[0]) <= 15:
                    found["phone"].append(("phone", at, m.end()))
        elif kind == "login":
            start = at
            while start > past["login"] and text[start - 1] in _SCHEME:
                start -= 1
            if start < at and (m := _LOGIN.match(text, after)):
                add("login", start, m.end())
        else:
            if at < past[kind] or (at and text[at - 1].isalnum()) or text[after: after + 1].isalpha():
                continue
            start = _FILLER.match(text, after).end()
            if kind == "iban":
                m = _IBAN.match(text, start)
                number = m[0].replace(" ", "") if m else ""
                while len(number) >= 15 and not iban_ok(number):  # words may follow the number
                    number = number[:-1]
                if len(number) >= 15:
                    end, left = start, len(number)
                    while left:
                        left -= text[end] != " "
                        end += 1
                    add("iban", start, end)
            elif (m := _IDENT.match(text, start)) and sum(c in _DIGITS for c in m[0]) >= 5:
                add("account", start, m.end())
    return [s for k in KINDS for s in found[k]]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` with all spans of every whole text, in one map-only pass."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in find(t.as_py() or "")] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, _SPANS)], ["doc_id", "spans"])

    source = docs.select("doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(scan, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span replaced by ``<KIND>``; overlapping spans go together under the first's name."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the personal data of ``text`` replaced (and ``n_chars`` counted anew where there is
    such a column); all rows and columns stay."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([None if (t := x.as_py()) is None else redacted(t, s) if (s := find(t)) else t
                              for x in batch.column("text")], pa.string())
            columns = list(batch.columns)
            for name, new in (("text", texts), ("n_chars", pc.utf8_length(texts))):
                if (i := batch.schema.get_field_index(name)) >= 0:
                    columns[i] = new.cast(columns[i].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(clean, docs.schema)


def op9_pii_anchor_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = find_spans(read(spark, sf_dir, "documents"))
    line = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return s.select(
        "doc_id", *(count(k) for k in BASE_KINDS),
        F.sha2(line(F.filter("spans", lambda x: x["kind"].isin(*BASE_KINDS))).cast("binary"), 256).alias("base_sha256"),
        line(F.col("spans")).alias("spans"))
