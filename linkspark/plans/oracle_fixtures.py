"""DuckDB text of the fixture views, composed into self-contained oracle queries.

``with_views(body, *names)`` prefixes ``body`` with a ``WITH`` clause holding the
named views and everything they depend on, in dependency order.
"""

from __future__ import annotations

_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_catalog": ((), """SELECT DISTINCT concat('db', CAST(k AS VARCHAR)) AS db_id,
        CASE WHEN k = 1 THEN upper(p_brand) ELSE p_brand END AS tbl, p_name AS col
        FROM part, (SELECT unnest([0, 1, 2]) AS k) u WHERE (CAST(right(p_brand, 1) AS INTEGER) + k) % 3 <> 0"""),
    "fx_base": ((), """SELECT l_orderkey AS question_id, concat('db', CAST(l_orderkey % 3 AS VARCHAR)) AS db_id, l_linenumber AS ln, l_partkey AS pk,
        p_brand AS tbl, p_name AS col FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "fx_qids": ((), "SELECT DISTINCT l_orderkey AS question_id FROM lineitem"),
    "gold_ids": ((), "SELECT DISTINCT l_orderkey AS question_id FROM lineitem WHERE (l_orderkey + l_partkey) % 3 <> 0"),
    "vote_ids": ((), """SELECT DISTINCT l_orderkey AS question_id, voter
        FROM (SELECT *, unnest([1, 2, 3, 4]) AS voter FROM lineitem) l
        WHERE (l_partkey * voter + l_orderkey + l_linenumber) % 5 > 1"""),
    "fx_gold": (("fx_base",), """SELECT DISTINCT question_id, db_id, tbl,
        CASE WHEN ln = 7 THEN NULL ELSE col END AS col
        FROM fx_base WHERE (question_id + pk) % 3 <> 0"""),
    "fx_votes": (("fx_base",), """SELECT question_id, db_id, voter,
        CASE WHEN (pk + voter) % 17 = 0 THEN 'Brand#99' WHEN (pk + voter) % 2 = 0 THEN upper(tbl) ELSE tbl END AS tbl,
        CASE WHEN ln = 7 THEN NULL WHEN (pk + voter) % 13 = 0 THEN 'no such column'
             WHEN (pk + voter) % 3 = 0 THEN upper(col) ELSE col END AS col
        FROM (SELECT *, unnest([1, 2, 3, 4]) AS voter FROM fx_base) b
        WHERE (pk * voter + question_id + ln) % 5 > 1"""),
    "fx_docs": ((), "SELECT source AS db_id, doc_id AS table_idx, text FROM documents"),
    "fx_questions": ((), """SELECT item_id AS question_id,
        concat('src', CAST(item_id % 20 AS VARCHAR(10))) AS db_id, text AS question FROM benchmark"""),
    "fx_vec": ((), "SELECT vec_id, label AS db_id, embedding FROM embeddings"),
    "fx_raw": ((), """SELECT event_id, CASE event_id % 6
          WHEN 0 THEN j WHEN 1 THEN concat('```json', chr(10), j, chr(10), '```')
          WHEN 2 THEN concat('Sure! Here you go:', chr(10), j)
          WHEN 3 THEN concat(j, '<|im_end|>') WHEN 4 THEN 'no json here' ELSE concat('{bad} ', j) END AS raw,
          event_type, user_id
        FROM (SELECT event_id, event_type, user_id, concat('{"', event_type, '": ',
                CASE WHEN user_id % 7 = 0 THEN '[]' WHEN user_id % 11 = 0 THEN 'null'
                ELSE concat('["c', CAST(user_id % 5 AS VARCHAR(10)), '"]') END, '}') AS j FROM events) e"""),
    "fx_cand": ((), """SELECT d.source AS db_id, d.doc_id AS pos, d.text AS question,
          CASE WHEN l.quality IS NULL THEN '' ELSE 'select 1' END AS gold_sql,
          coalesce(l.quality, 0) = 0 AS parse_failed, CASE WHEN l.toxic = 1 THEN 0 ELSE 1 END AS n_tables
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""),
    "fx_runs": ((), """SELECT user_id % 10 AS experiment, user_id AS run, event_type AS metric,
        event_id AS step, value FROM events"""),
    "fx_mentions": ((), """SELECT l_orderkey AS query_id, concat('db', CAST(l_orderkey % 3 AS VARCHAR)) AS db_id, concat('t', CAST(l_linenumber AS VARCHAR(10))) AS alias,
          p_brand AS tbl,
          CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE concat('t', CAST(l_linenumber AS VARCHAR(10))) END AS col_alias,
          CASE WHEN l_linenumber = 7 THEN '*' ELSE lower(p_name) END AS col
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    # catalog lookups (one spelling per lower-cased key)
    "cat_t": (("fx_catalog",), "SELECT db_id, lower(tbl) AS tlc, min(tbl) AS tbl_c FROM fx_catalog GROUP BY db_id, lower(tbl)"),
    "cat_c": (("fx_catalog",), """SELECT db_id, lower(tbl) AS tlc, lower(col) AS clc, min(col) AS col_c FROM fx_catalog
        WHERE col IS NOT NULL AND col <> '' GROUP BY db_id, lower(tbl), lower(col)"""),
    # canonical normal form of the votes and of the gold
    "canon_raw": (("fx_votes", "cat_t", "cat_c"), """SELECT v.question_id, v.voter, t.tbl_c, c.col_c
        FROM fx_votes v JOIN cat_t t ON v.db_id = t.db_id AND lower(v.tbl) = t.tlc
        LEFT JOIN cat_c c ON c.db_id = t.db_id AND c.tlc = t.tlc AND c.clc = lower(v.col)"""),
    "canon": (("canon_raw",), """SELECT DISTINCT question_id, voter, lower(tbl_c) AS tlc, '' AS clc,
          tbl_c AS tbl, CAST(NULL AS VARCHAR) AS col FROM canon_raw
        UNION
        SELECT DISTINCT question_id, voter, lower(tbl_c) AS tlc, lower(col_c) AS clc, tbl_c AS tbl, col_c AS col
        FROM canon_raw WHERE col_c IS NOT NULL"""),
    "gold_raw": (("fx_gold", "cat_t", "cat_c"), """SELECT g.question_id, t.tbl_c, c.col_c
        FROM fx_gold g JOIN cat_t t ON g.db_id = t.db_id AND lower(g.tbl) = t.tlc
        LEFT JOIN cat_c c ON c.db_id = t.db_id AND c.tlc = t.tlc AND c.clc = lower(g.col)"""),
    "gold_n": (("gold_raw",), """SELECT DISTINCT question_id, lower(tbl_c) AS tlc, '' AS clc,
          tbl_c AS tbl, CAST(NULL AS VARCHAR) AS col FROM gold_raw
        UNION
        SELECT DISTINCT question_id, lower(tbl_c) AS tlc, lower(col_c) AS clc, tbl_c AS tbl, col_c AS col
        FROM gold_raw WHERE col_c IS NOT NULL"""),
    "votes": (("canon",), """SELECT question_id, tlc, clc, count(*) AS votes, bool_or(voter = 1) AS lead,
          min(tbl) AS tbl, min(col) AS col FROM canon GROUP BY question_id, tlc, clc"""),
}


def _order(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for dep in _VIEWS[n][0]:
            visit(dep)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <views and deps>, <extra ctes> <body>``."""
    ctes = [f"{n} AS ({_VIEWS[n][1]})" for n in _order(names)]
    for n, text in (extra or {}).items():
        ctes.append(f"{n} AS ({text})")
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body


def define(name: str, deps: tuple[str, ...], text: str) -> None:
    """Register an additional reusable view (used by the oracle module)."""
    _VIEWS[name] = (deps, text)


def view(name: str) -> tuple[tuple[str, ...], str]:
    """What a view depends on, and its text."""
    return _VIEWS[name]
