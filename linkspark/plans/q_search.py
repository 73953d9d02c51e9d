"""Ensemble combination search (D10) and its ranked report."""

from __future__ import annotations

import re
from itertools import combinations

from pyspark.sql import functions as F

from ..operators import canon as C
from ..operators import vote as V
from . import fixtures as fx
from .oracle_fixtures import define, view, with_views
from .q_scoring import R, canon_gold, canon_votes
from .registry import query

# Parameter table (not data): every combination of two or more voters, lead = lowest id.
COMBOS = [c for k in range(2, len(fx.VOTERS) + 1) for c in combinations(fx.VOTERS, k)]


def combo_rows():
    return [("+".join(map(str, c)), v, i + 1) for c in COMBOS for i, v in enumerate(c)]


_values = ", ".join(f"('{c}', {v}, {r})" for c, v, r in combo_rows())
define("combos", (), f"SELECT * FROM (VALUES {_values}) t(combo, voter, rank)")
define("sr_votes", ("canon", "combos"), """SELECT b.combo, c.question_id, c.tlc, c.clc, count(*) AS votes,
      bool_or(b.rank = 1) AS lead FROM canon c JOIN combos b ON c.voter = b.voter
    GROUP BY b.combo, c.question_id, c.tlc, c.clc""")
define("sr_pred", ("sr_votes",), """SELECT combo, 'union' AS mode, question_id, tlc, clc FROM sr_votes
    UNION ALL SELECT combo, 'maj2', question_id, tlc, clc FROM sr_votes WHERE votes >= 2
    UNION ALL SELECT combo, 'maj2_or_lead', question_id, tlc, clc FROM sr_votes WHERE votes >= 2 OR lead""")
define("sr_cells", ("combos",), """SELECT combo, unnest(['union', 'maj2', 'maj2_or_lead']) AS mode
    FROM (SELECT DISTINCT combo FROM combos) c""")
define("sr_eval", ("gold_n", "gold_ids"), """SELECT i.question_id,
      count(g.tlc) FILTER (WHERE g.clc = '') AS n_gold_t, count(g.tlc) FILTER (WHERE g.clc <> '') AS n_gold_c
    FROM gold_ids i LEFT JOIN gold_n g ON g.question_id = i.question_id GROUP BY i.question_id""")
define("sr_counts", ("sr_pred", "sr_cells", "sr_eval", "gold_n"), """SELECT c.combo, c.mode, e.question_id, e.n_gold_t, e.n_gold_c,
      count(p.tlc) FILTER (WHERE p.clc = '') AS n_pred_t, count(p.tlc) FILTER (WHERE p.clc <> '') AS n_pred_c,
      count(g.tlc) FILTER (WHERE p.clc = '') AS tp_t, count(g.tlc) FILTER (WHERE p.clc <> '') AS tp_c
    FROM sr_cells c CROSS JOIN sr_eval e
    LEFT JOIN sr_pred p ON p.combo = c.combo AND p.mode = c.mode AND p.question_id = e.question_id
    LEFT JOIN gold_n g ON g.question_id = p.question_id AND g.tlc = p.tlc AND g.clc = p.clc
    GROUP BY c.combo, c.mode, e.question_id, e.n_gold_t, e.n_gold_c""")


def _prf(tp, npred, ngold, s):
    p = f"(CASE WHEN {npred} = 0 THEN (CASE WHEN {ngold} = 0 THEN 1.0 ELSE 0.0 END) ELSE CAST({tp} AS DOUBLE) / {npred} END)"
    r = f"(CASE WHEN {ngold} = 0 THEN 1.0 ELSE CAST({tp} AS DOUBLE) / {ngold} END)"
    f = f"(CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END)"
    return f"{p} AS p_{s}, {r} AS r_{s}, {f} AS f_{s}"


define("sr_scores", ("sr_counts",), f"""SELECT combo, mode,
      avg(p_t + r_t + f_t) / 3.0 AS ts, avg(p_c + r_c + f_c) / 3.0 AS cs
    FROM (SELECT combo, mode, {_prf('tp_t', 'n_pred_t', 'n_gold_t', 't')}, {_prf('tp_c', 'n_pred_c', 'n_gold_c', 'c')}
          FROM sr_counts) x GROUP BY combo, mode""")

SEARCH_SQL_BODY = f"""SELECT combo, mode, round(ts, {R}) AS table_score, round(cs, {R}) AS column_score,
      round(0.5 * ts + 0.5 * cs, {R}) AS leaderboard FROM sr_scores"""


def search(spark, d):
    return V.ensemble_search(canon_votes(spark, d), canon_gold(spark, d), COMBOS,
                             fx.fx_gold_ids(spark, d), digits=R)


@query("ensemble_search", with_views(SEARCH_SQL_BODY, "sr_scores"))
def q_ensemble_search(spark, d):
    return search(spark, d)


@query("top10_combos", with_views(f"""
    SELECT combo, mode, leaderboard, position, max(leaderboard) OVER (ORDER BY position) AS running_best FROM (
      SELECT combo, mode, leaderboard, row_number() OVER (ORDER BY leaderboard DESC, combo, mode) AS position
      FROM ({SEARCH_SQL_BODY}) s) r WHERE position <= 10""", "sr_scores"))
def q_top10_combos(spark, d):
    return V.top_cells(search(spark, d), 10).select(
        "combo", "mode", "leaderboard", F.col("position").cast("long").alias("position"), "running_best")


# D10 at the size of a real search: twelve voters; a triple, with each of the nine others, and with each two of them.
MANY = tuple(range(1, 13))
MANY_COMBOS = [MANY[:3] + extra for k in range(3) for extra in combinations(MANY[3:], k)]
_many_rows = [("+".join(map(str, c)), v, i + 1) for c in MANY_COMBOS for i, v in enumerate(c)]
_renamed = ("fx_votes", "canon_raw", "canon", "combos", "sr_votes", "sr_pred", "sr_cells", "sr_counts", "sr_scores")


def _many(text: str) -> str:
    return re.sub(r"\b(" + "|".join(_renamed) + r")\b", r"\1_many", text)


for _name in _renamed:
    _deps, _text = view(_name)
    if _name == "combos":
        _text = "SELECT * FROM (VALUES " + ", ".join(f"('{c}', {v}, {r})" for c, v, r in _many_rows) + ") t(combo, voter, rank)"
    _text = _text.replace("unnest([1, 2, 3, 4])", f"unnest({list(MANY)})")
    define(f"{_name}_many", tuple(map(_many, _deps)), _text if _name == "combos" else _many(_text))


@query("ensemble_search_many", with_views(_many(SEARCH_SQL_BODY), "sr_scores_many"))
def q_ensemble_search_many(spark, d):
    """46 combinations in three modes: 138 cells."""
    votes = C.canonicalize(fx.fx_votes(spark, d, MANY), fx.fx_catalog(spark, d), keys=["question_id", "voter"], exchange=False)
    return V.ensemble_search(votes, canon_gold(spark, d), MANY_COMBOS, fx.fx_gold_ids(spark, d), digits=R)
