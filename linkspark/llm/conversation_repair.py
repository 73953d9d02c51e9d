"""Conversation structure repair by a grammar-compressed dynamic programme.

Each row of a conversation becomes one symbol: its role's initial and its fault.  The repaired roles must read
``(s?(ua)+)?``, an automaton of four states, so a symbol is a 4 x 4 matrix over (least cost, audit): the cheapest
edits, ASCII-least among those, that lead from one state to another, empty turns inserted before the row included.
Matrices of neighbouring stretches multiply in the min-plus sense, with audits joined on.

Re-Pair makes a grammar over the sequences of all conversations: a round counts all pairs of neighbouring symbols
(in tasks, added up by Spark) and turns the most frequent ones that share no symbol into rules.  The rules' matrices
are evaluated bottom-up, once, and go to all tasks; audits are ropes that share the audits of the parts.  A
conversation is then a short product of the matrices of its symbols.

Rows are exchanged without their texts to find repeats and orders, and once with them, to hash what the repair
leaves, in a stream.  A task holds a byte a row of a conversation, its audit, and never its texts; the
digest of a conversation is one sequence, so all rows of a conversation pass through one task.

Defined cases: a null role or text counts as one space, a null ``conv_id`` is a conversation of its own; rows go by
turn (nulls first), then role and MD5 of the text, so equal rows are neighbours; a role's initial is its first
character, and no role that starts otherwise than with s, u or a can be kept; rows that are equal in
everything are repeats; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkspark.llm.common import materialise, read

KEEP, REROLE, DELETE, INSERT = "KRDI"
CHANGE, REMOVE, PENALTY = 3, 4, 3
#: What the automaton's states (nothing yet, after s, after u, after a) become on a role; it may end in the first and last.
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
STATES, ENDS = 4, (0, 3)
ROLES = {"u": "user", "a": "assistant"}
ASCII_SPACE = " \t\n\x0b\x0c\r"
#: One character a symbol: initial (s, u, a, other) without and with a truncated text, then rows that must go.
SYMBOLS, GONE, FIRST_RULE = "suaxSUAX", "-", 0x100
MAX_ROUNDS, MAX_RULES, LEAST_COUNT = 8, 4096, 2


# -- the dynamic programme

class Rope:
    """A string made of two ropes, or a plain one."""

    __slots__ = ("left", "right", "text", "length")

    def __init__(self, left: Rope | None, right: Rope | None, text: str = ""):
        self.left, self.right, self.text = left, right, text
        self.length = left.length + right.length if left else len(text)

    def __add__(self, other: Rope) -> Rope:
        return other if not self.length else self if not other.length else Rope(self, other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            r = todo.pop()
            if r.left:
                todo += (r.right, r.left)
            else:
                out.append(r.text)
        return "".join(out)


def before(a: Rope, b: Rope) -> bool:
    """Is ``a`` the ASCII-less of two audits?  What they share on the left is walked past, not read."""
    rest_a, rest_b = [], []
    while a is not b:
        if a.length >= b.length and a.left:
            rest_a.append(a.right)
            a = a.left
        elif b.left:
            rest_b.append(b.right)
            b = b.left
        elif a.left:
            rest_a.append(a.right)
            a = a.left
        else:
            rest_a.append(a)
            rest_b.append(b)
            break
    return "".join(map(str, reversed(rest_a))) < "".join(map(str, reversed(rest_b)))


Cell = tuple[int, Rope]
Matrix = dict[tuple[int, int], Cell]


def better(a: Cell | None, b: Cell) -> Cell:
    if a is None or b[0] < a[0]:
        return b
    return b if b[0] == a[0] and before(b[1], a[1]) else a


def multiply(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = {}
    for (p, q), (cost, audit) in a.items():
        for r in range(STATES):
            if (more := b.get((q, r))) is not None:
                cell = out.get((p, r))
                if cell is None or cost + more[0] <= cell[0]:
                    out[p, r] = better(cell, (cost + more[0], audit + more[1]))
    return out


def insertions() -> Matrix:
    """Empty turns between two rows: none, or the fewest from state to state."""
    one: Matrix = {(p, p): (0, Rope(None, None)) for p in range(STATES)}
    for steps in (STEPS["u"], STEPS["a"]):
        for p, q in steps.items():
            one[p, q] = (CHANGE, Rope(None, None, INSERT))
    return multiply(multiply(one, one), one)


def row_matrix(symbol: str) -> Matrix:
    """Insertions, then what may be done with the row itself."""
    row: Matrix = {(p, p): (REMOVE, Rope(None, None, DELETE)) for p in range(STATES)}
    if symbol != GONE:
        extra = PENALTY * symbol.isupper()
        kept = STEPS.get(symbol.lower(), {})
        for edit, cost, steps in ((KEEP, 0, kept), *((REROLE, CHANGE, STEPS[r]) for r in ROLES)):
            for p, q in steps.items():
                row[p, q] = better(row.get((p, q)), (cost + extra, Rope(None, None, edit)))
    return multiply(insertions(), row)


@dataclass
class Grammar:
    """Rules in the order they were made; rule ``k`` is the symbol ``FIRST_RULE + k``."""

    rules: list[str] = field(default_factory=list)  # two symbols each

    def compress(self, lines: str) -> str:
        """Sequences, one a line, in symbols of the grammar."""
        for k, pair in enumerate(self.rules):
            lines = lines.replace(pair, chr(FIRST_RULE + k))
        return lines

    def matrices(self) -> dict[str, Matrix]:
        out = {s: row_matrix(s) for s in SYMBOLS + GONE}
        for k, pair in enumerate(self.rules):
            out[chr(FIRST_RULE + k)] = multiply(out[pair[0]], out[pair[1]])
        return out


def solve(compressed: str, matrices: dict[str, Matrix], after: Matrix) -> tuple[int, str]:
    """The least cost and the audit of a sequence of the grammar's symbols."""
    at: dict[int, Cell] = {0: (0, Rope(None, None))}
    for m in [matrices[s] for s in compressed] + [after]:
        then: dict[int, Cell] = {}
        for (p, q), (cost, audit) in m.items():
            if p in at:
                total, cell = at[p][0] + cost, then.get(q)
                if cell is None or total <= cell[0]:
                    then[q] = better(cell, (total, at[p][1] + audit))
        at = then
    best = None
    for q in ENDS:
        if q in at:
            best = better(best, at[q])
    return best[0], str(best[1])


# -- rows to sequences

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults planted by a hash of their place: some dropped, emptied, cut short, repeated or given
    another role."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("kind != 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(times).alias("copy")).drop("copy")


def keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``digest``, which orders rows of one turn and role."""
    return rows.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))


ORDER = ("turn", "role", "digest")


def sequences(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, symbols`` (a character a row) and the counts of gaps and faults."""
    trimmed = F.rtrim(F.col("text"), F.lit(ASCII_SPACE))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy("turn")) > 1
    initial = F.substring("role", 1, 1)
    small = rows.select(
        "conv_id", "turn", "role", "digest", (F.length(trimmed) == 0).alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("cut"))
    small = small.select("conv_id", "turn", "role", "digest", initial.alias("initial"),
                         F.when(F.col("blank"), "b").when(seen, "d").when(F.col("cut"), "t").otherwise("").alias("fault"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        symbols, faults, illegal, previous, turn, first_turn, distinct = [], Counter(), 0, "", None, None, 0
        out: list[tuple] = []

        def close() -> None:
            gaps = turn - first_turn + 1 - distinct if distinct else 0
            out.append((held[0], "".join(symbols), gaps, faults["b"], faults["d"], faults["t"], illegal))

        for batch in batches:
            for conv, t, start, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault"))):
                if held is None or held[0] != conv:
                    if held is not None:
                        close()
                    held, symbols, faults, illegal, previous, turn, first_turn, distinct = (conv,), [], Counter(), 0, None, None, None, 0
                if t is not None and t != turn:
                    first_turn, turn, distinct = t if first_turn is None else first_turn, t, distinct + 1
                illegal += previous is not None and previous + start not in ("su", "ua", "au")
                previous = start
                faults[fault] += 1
                symbol = start if start in STEPS else "x"
                symbols.append(GONE if fault in ("b", "d") else symbol.upper() if fault else symbol)
            if len(out) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SEQUENCES)], schema=_SEQUENCES)
                out.clear()
        if held is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SEQUENCES)], schema=_SEQUENCES)

    return small.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER).select("conv_id", "turn", "initial", "fault").mapInArrow(
        run, "conv_id long, symbols string, gaps long, blank long, duplicate long, truncated long, illegal long")


_SEQUENCES = pa.schema([("conv_id", pa.int64()), ("symbols", pa.string()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))])


def _lines(batch: pa.RecordBatch, grammar: Grammar) -> list[str]:
    return grammar.compress("\n".join(batch.column("symbols").to_pylist())).split("\n") if len(batch) else []


def learn(found: DataFrame, max_rounds: int = MAX_ROUNDS, max_rules: int = MAX_RULES) -> Grammar:
    """A Re-Pair grammar over all ``symbols``, several rules a round."""
    grammar = Grammar()
    for _ in range(max_rounds):
        def pairs(batches: Iterator[pa.RecordBatch], grammar: Grammar = grammar) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n: Counter[str] = Counter()
                for line in _lines(batch, grammar):
                    n.update(map("".join, zip(line, line[1:])))
                yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["pair", "n"])

        counts = found.select("symbols").mapInArrow(pairs, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        # at most two symbols for each pair taken, so the pairs needed lie among the first of this bounded list
        top = counts.where(F.col("n") >= LEAST_COUNT).orderBy(F.desc("n"), "pair").limit(max_rules).collect()
        taken: set[str] = set()
        rules = []
        for r in top:
            if not taken & set(r["pair"]) and len(grammar.rules) + len(rules) < max_rules:
                taken |= set(r["pair"])
                rules.append(r["pair"])
        if not rules:
            break
        grammar = Grammar(grammar.rules + rules)
    return grammar


def repaired(found: DataFrame, grammar: Grammar) -> DataFrame:
    """``found`` (from ``sequences``) with ``cost`` and ``audit`` in place of ``symbols``."""
    shared = found.sparkSession.sparkContext.broadcast(grammar)  # at most MAX_RULES rules

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices, after = shared.value.matrices(), insertions()
        known: dict[str, tuple[int, str]] = {}
        for batch in batches:
            costs, audits = [], []
            for line in _lines(batch, shared.value):
                answer = known.get(line) or solve(line, matrices, after)
                if len(line) <= 8 and len(known) < 10_000:
                    known[line] = answer
                costs.append(answer[0])
                audits.append(answer[1])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names if c != "symbols"), pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
                [*(c for c in batch.schema.names if c != "symbols"), "cost", "audit"])

    return found.mapInArrow(run, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def apply_audit(audit: str, roles: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """``role, text`` of the repaired conversation, from those of its rows in order."""
    expected = "ua"
    for edit in audit:
        role, text = next(roles) if edit != INSERT else ("", "")
        if edit == DELETE:
            continue
        if edit == KEEP and role[0] == "s":
            yield role, text
            continue
        yield (role if edit == KEEP else ROLES[expected[0]]), text
        expected = expected[::-1]


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (``conv_id, turn, role, text``, no nulls but in the first two) with its
    faults, the cheapest repair and the repaired conversation's digest."""
    rows = keyed(rows)
    found = materialise(sequences(rows), "repair-sequences")
    answers = repaired(found, learn(found))
    stats = [c for c in answers.columns if c != "conv_id"]
    blank = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in [*answers.schema, *rows.schema]}
    tagged = answers.select("conv_id", F.lit(0).alias("tag"), *stats, *(blank[c] for c in (*ORDER, "text"))).unionByName(
        rows.select("conv_id", F.lit(1).alias("tag"), *(blank[c] for c in stats), *ORDER, "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[dict]:
            for batch in batches:
                for at in range(0, len(batch), 256):
                    yield from batch.slice(at, 256).to_pylist()

        stream = records()
        held: list[dict] = []  # the next conversation's first record, once it has been read

        def rows_of() -> Iterator[tuple[str, str]]:
            for r in stream:
                if r["tag"] == 0:
                    held.append(r)
                    return
                yield r["role"], r["text"]

        first = next(stream, None)
        out: list[dict] = []
        while first is not None:
            digest, start, here = hashlib.sha256(), True, rows_of()
            for role, text in apply_audit(first["audit"], here):
                digest.update(f"{'' if start else chr(10)}{role}:{text}".encode())
                start = False
            for _ in here:  # there are none; this reads on to the next conversation
                pass
            out.append({"conv_id": first["conv_id"], **{c: first[c] for c in stats}, "repaired_sha256": digest.hexdigest()})
            first = held.pop() if held else None
            if len(out) >= 1024 or first is None:
                yield pa.RecordBatch.from_pylist(out, schema=_REPAIRED)
                out = []

    return tagged.repartition("conv_id").sortWithinPartitions("conv_id", "tag", *ORDER).drop("turn", "digest").mapInArrow(
        run, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


_REPAIRED = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                       ("audit", pa.string()), ("repaired_sha256", pa.string())])


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                                        "role", "text")
    done = repair(damaged(given)).withColumnRenamed("conv_id", "c")
    ids = given.select("conv_id").distinct()
    or_zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.join(done, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", *or_zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def _plus(cell: str, cost: str | int, edits: str) -> str:
    """SQL: a cell of the table below after more edits.  A cell is the cost in ten digits, then the audit, so the
    least string is the cheapest and ASCII-least one; null is no way there."""
    return f"lpad(CAST(CAST(left({cell}, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || substr({cell}, 11) || {edits}"


def _inserted(c: str) -> list[str]:
    """SQL: the cells of the four states after insertions."""
    one, two = (lambda p: _plus(f"{c}{p}", CHANGE, "'I'")), (lambda p: _plus(f"{c}{p}", 2 * CHANGE, "'II'"))
    return [f"{c}0", f"{c}1", f"least({c}2, {one(0)}, {one(1)}, {one(3)})", f"least({c}3, {one(2)}, {two(0)}, {two(1)})"]


def _as_role(cell: str, role: str) -> str:
    return (f"CASE WHEN initial = '{role}' THEN {_plus(cell, 'extra', chr(39) + KEEP + chr(39))} "
            f"ELSE {_plus(cell, f'{CHANGE} + extra', chr(39) + REROLE + chr(39))} END")


_I = _inserted("s")
_DELETED = [_plus(f"i{p}", REMOVE, f"'{DELETE}'") for p in range(STATES)]
OP12_SQL = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, b: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
), given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place
  FROM conversations
), hashed AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(place, ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS kind
  FROM given, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, range(2) AS copies(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
), numbered AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS n,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed
  FROM damaged
), faulty AS (
  SELECT *, CASE WHEN trimmed = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'd'
    WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY n) AS previous
  FROM numbered
), stats AS (
  SELECT conv_id, max(n) AS rows_left, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
), cells AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, lpad('0', 10, '0') AS s0, CAST(NULL AS VARCHAR) AS s1, CAST(NULL AS VARCHAR) AS s2,
    CAST(NULL AS VARCHAR) AS s3
  FROM stats
  UNION ALL
  SELECT conv_id, n, {_DELETED[0]},
    CASE WHEN gone OR initial <> 's' THEN {_DELETED[1]} ELSE least({_DELETED[1]}, {_plus("i0", "extra", "'K'")}) END,
    CASE WHEN gone THEN {_DELETED[2]} ELSE least({_DELETED[2]}, {_as_role("least(i0, i1, i3)", "u")}) END,
    CASE WHEN gone THEN {_DELETED[3]} ELSE least({_DELETED[3]}, {_as_role("i2", "a")}) END
  FROM (
    SELECT f.conv_id, f.n, f.initial, f.fault IN ('b', 'd') AS gone, CASE WHEN f.fault = 't' THEN {PENALTY} ELSE 0 END AS extra,
      {", ".join(f"{cell} AS i{p}" for p, cell in enumerate(_I))}
    FROM cells JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM cells.conv_id AND f.n = cells.n + 1)
), best AS (
  SELECT c.conv_id, least({_I[0]}, {_I[3]}) AS cell
  FROM cells c JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.rows_left = c.n
), edits AS (
  SELECT conv_id, k, substr(cell, 10 + k, 1) AS edit,
    count(*) FILTER (substr(cell, 10 + k, 1) <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS n
  FROM (SELECT conv_id, cell, CAST(unnest(range(1, length(cell) - 9)) AS INTEGER) AS k FROM best)
), survivors AS (
  SELECT e.conv_id, e.k, e.edit, f.role, f.text,
    count(*) FILTER (NOT (e.edit = 'K' AND f.initial = 's')) OVER (PARTITION BY e.conv_id ORDER BY e.k) AS place
  FROM edits e LEFT JOIN faulty f ON e.edit <> 'I' AND f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.n = e.n
  WHERE e.edit <> 'D'
), digests AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS repaired
  FROM survivors GROUP BY conv_id
)
SELECT g.conv_id, CAST(coalesce(s.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(s.blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(s.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(s.truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(s.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(CAST(left(b.cell, 10) AS BIGINT), 0) AS BIGINT) AS cost,
  coalesce(substr(b.cell, 11), '') AS audit, sha256(coalesce(d.repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g
LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN digests d ON d.conv_id IS NOT DISTINCT FROM g.conv_id
"""
