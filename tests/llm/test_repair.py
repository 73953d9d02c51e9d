"""Conversation repair: the grammar against a plain programme, the query against its SQL on odd rows."""

import hashlib
import random
import re
import zlib

import pytest

from linkspark.llm import conversation_repair as cr
from test_odd_rows import same, table, twin

TURNS = "conv_id long, turn long, role string, text string, n string, symbols int, digest string, tag string, audit int, copy int"
CLASH = ("n", 1, "d", "t", 2, 3)


def plain(symbols):
    """The least (cost, audit), from the end to the beginning, with whole strings."""
    after = {0: (0, ""), 3: (0, "")}

    def with_insertions(cells):
        for _ in range(4):
            for steps in (cr.STEPS["u"], cr.STEPS["a"]):
                for p, q in steps.items():
                    if q in cells:
                        cells[p] = min(cells.get(p, (1 << 60, "")), (cells[q][0] + 3, "I" + cells[q][1]))
        return cells

    after = with_insertions(after)
    for symbol in reversed(symbols):
        here = {}
        for p in range(4):
            ways = [(after[p][0] + 4, "D" + after[p][1])] if p in after else []
            if symbol != cr.GONE:
                extra = 3 * symbol.isupper()
                for role, steps in cr.STEPS.items():
                    q = steps.get(p)
                    if q in after:
                        if role == symbol.lower():
                            ways.append((after[q][0] + extra, "K" + after[q][1]))
                        if role != "s":
                            ways.append((after[q][0] + extra + 3, "R" + after[q][1]))
            if ways:
                here[p] = min(ways)
        after = with_insertions(here)
    return after[0]


def test_grammar_against_plain():
    rng = random.Random(5)
    lines = ["".join(rng.choices("uaUAsSx-", [9, 9, 2, 2, 1, 1, 1, 2], k=rng.randrange(1, 40))) for _ in range(400)] + ["ua" * 300, "-" * 50, "u" * 64]
    grammar = cr.Grammar(["ua", "UA", "u-", chr(0x100) * 2, chr(0x103) + "s", "ss", "-u", chr(0x103) * 2])
    matrices, after = grammar.matrices(), cr.insertions()
    for line, short in zip(lines, grammar.compress("\n".join(lines)).split("\n")):
        assert cr.solve(short, matrices, after) == cr.solve(line, matrices, after) == plain(line), line


def test_ropes_compare_as_strings():
    rng = random.Random(6)
    ropes = [cr.Rope(None, None, c) for c in ("", "D", "I", "K", "R", "DK")]
    for _ in range(3000):
        a, b = rng.choice(ropes[-40:]), rng.choice(ropes)
        assert cr.before(a, b) == (str(a) < str(b)) and cr.before(b, a) == (str(b) < str(a))
        if a.length + b.length < 60:
            ropes.append(a + b)


def test_a_long_conversation_is_solved():
    line = "uaUa-sau" * 20_000
    cost, audit = cr.solve(line, {s: cr.row_matrix(s) for s in cr.SYMBOLS + cr.GONE}, cr.insertions())
    assert len(audit.replace("I", "")) == len(line) and cost > 0
    roles = "".join(r[0] for r, _ in cr.apply_audit(audit, iter([(c if c in "sua" else "x", "") for c in line.lower()])))
    assert re.fullmatch("(s?(ua)+)?", roles)


def independent(rows):
    """The contract, conversation by conversation, in plain Python."""
    convs = {}
    for conv, turn, role, text in rows:
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(place.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        convs.setdefault(conv, []).extend([(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1))
    for conv, got in convs.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        symbols, seen, n = "", set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in got:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            s = role[:1] if role[:1] in ("s", "u", "a") else "x"
            symbols += "-" if fault in ("blank", "duplicate") else s.upper() if fault else s
        cost, audit = plain(symbols)
        turns = [t for t, _, _ in got if t is not None]
        starts = [r[:1] for _, r, _ in got]
        left = "\n".join(f"{r}:{t}" for r, t in cr.apply_audit(audit, iter([(r, t) for _, r, t in got])))
        yield {"conv_id": conv, "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **n,
               "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:])), "cost": cost, "audit": audit,
               "repaired_sha256": hashlib.sha256(left.encode()).hexdigest()}


def odd():
    rng = random.Random(8)
    texts = [None, "", " \t", "One.", "Two!", "No end", "Ünï? ", "three\x0b", "a: b\nuser:c."]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", None, "", "u", "System"]), rng.choice(texts))
            for c in [*range(60), None] for t in rng.sample(range(-3, 12), rng.randrange(1, 9))]
    rows += [(70, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(500)]
    rows += [(71, 3, "user", "Same.")] * 7 + [(72, None, "user", "A."), (72, None, "assistant", "B."), (72, 2, "user", "C.")]
    rows += [(73, 0, "user", "long " * 50_000 + "."), (73, 1, "assistant", "long " * 50_000)]
    return rows


def test_odd_rows(spark, tmp_path):
    rows = odd()
    path = table(spark, tmp_path, "conversations", [(*r, *CLASH) for r in rows], TURNS)
    got = cr.op12_conversation_repair(spark, str(tmp_path))
    same(got, twin(cr.OP12_SQL, conversations=path))
    plainly = {r["conv_id"]: r for r in independent(rows)}
    for r in got.collect():
        assert r.asDict() == plainly[r.conv_id]


def test_dropped_rows_leave_zeros(spark, tmp_path):
    gone = [(c, 0, "user", "Hi.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    table(spark, tmp_path, "conversations", [(*r, *CLASH) for r in gone], TURNS)
    got = cr.op12_conversation_repair(spark, str(tmp_path)).collect()
    assert len(got) == len(gone) > 5
    assert {tuple(r)[1:] for r in got} == {(0,) * 6 + ("", hashlib.sha256(b"").hexdigest())}


def test_no_rows(spark, tmp_path):
    table(spark, tmp_path, "conversations", [], TURNS)
    assert cr.op12_conversation_repair(spark, str(tmp_path)).collect() == []


def test_rules_are_learned(spark):
    found = spark.createDataFrame([("ua" * 64,)] * 3 + [("su",), ("uaua",)], "symbols string")
    grammar = cr.learn(found)
    assert grammar.rules[0] == "ua" and len(grammar.compress("ua" * 64)) <= 2
    assert cr.learn(found.limit(0)).rules == []


@pytest.mark.parametrize("audit,rows,want", [
    ("KKK", "sua", "system user assistant"), ("DKI", "xu", "user assistant"), ("RR", "ua", "user assistant"), ("", "", ""), ("II", "", "user assistant")])
def test_audits_are_applied(audit, rows, want):
    full = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    assert " ".join(r for r, _ in cr.apply_audit(audit, iter([(full[c], "t") for c in rows]))) == want
