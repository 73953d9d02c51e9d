"""Combine several predictors by voting.

Input is the canonical normal form (see :mod:`linkspark.operators.canon`) with a
``voter`` column.  Because every voter that names a column also carries that
table's row, the three ensemble modes reduce to a *row filter* over one vote
aggregation keyed on ``(question, tlc, clc)``:

* ``union``        keep every row;
* ``maj``          keep rows with at least ``k`` distinct voters (a column with k
                   votes implies its table has k votes, so tables follow);
* ``maj_or_lead``  additionally keep every row the lead voter emitted (a lead
                   column implies a lead table row).

So one shuffle (the vote aggregation, map-side combined) produces every mode.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODES = ("union", "maj2", "maj2_or_lead")


def vote_counts(canon: DataFrame, keys: Sequence[str] = ("question_id",), voter: str = "voter",
                voter_rank: str | None = None, lead_voter=None) -> DataFrame:
    """Distinct voters per (question, table) and per (question, table, column).

    ``canon`` must be de-duplicated per voter on ``(keys, tlc, clc)`` (as produced by
    :func:`canonicalize` per voter).  Output spelling = the earliest voter's spelling
    (``voter_rank`` ascending; defaults to the voter id).  ``lead`` is true when the
    lead voter (lowest rank unless ``lead_voter`` is given) emitted the identifier.
    """
    keys = list(keys)
    rank = F.col(voter_rank) if voter_rank else F.col(voter)
    df = canon.withColumn("_rank", rank)
    # without an explicit id, the lead is the lowest rank among all voters (one more pass over the links)
    lead = F.col("_rank") == df.agg(F.min("_rank")).scalar() if lead_voter is None else F.col(voter) == F.lit(lead_voter)
    return (df.groupBy(*keys, "tlc", "clc").agg(
        F.count(F.lit(1)).alias("votes"),
        F.max(lead.cast("int")).cast("boolean").alias("lead"),
        F.min_by("tbl", "_rank").alias("tbl"),
        F.min_by("col", "_rank").alias("col")))


def vote_filter(votes: DataFrame, mode: str = "maj2", k: int = 2) -> DataFrame:
    """Keep the rows of the chosen ensemble mode.

    ``mode``: ``union`` | ``maj2`` | ``maj2_or_lead`` | ``kofn`` (uses ``k``).
    """
    if mode == "union":
        return votes
    if mode in ("maj2", "kofn"):
        need = 2 if mode == "maj2" else k
        return votes.where(F.col("votes") >= need)
    if mode == "maj2_or_lead":
        return votes.where((F.col("votes") >= 2) | F.col("lead"))
    raise ValueError(f"unknown aggregation mode {mode!r}")


def ensemble(canon: DataFrame, mode: str = "maj2", keys: Sequence[str] = ("question_id",),
             voter: str = "voter", k: int = 2, voter_rank: str | None = None,
             lead_voter=None) -> DataFrame:
    """Vote + filter; returns the normal form ``keys, tlc, clc, tbl, col, votes``."""
    votes = vote_counts(canon, keys, voter, voter_rank, lead_voter)
    return vote_filter(votes, mode, k).select(*keys, "tlc", "clc", "tbl", "col", "votes")


def pack_links(links: DataFrame, keys: Sequence[str] = ("question_id",),
               questions: DataFrame | None = None) -> DataFrame:
    """Normal form -> ``schema_links MAP<STRING, ARRAY<STRING>>`` per question.

    Columns are sorted by code point; a table without columns maps to ``[]``.
    The group is one question's links (bounded by the catalog width of the
    tables it names), never a whole corpus.  With ``questions`` there is one record per
    question of that list, with an empty map where no link is left.
    """
    keys = list(keys)
    per_table = (links.groupBy(*keys, "tlc").agg(
        F.min("tbl").alias("tbl"),
        F.array_sort(F.collect_set("col")).alias("cols")))
    packed = per_table.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("tbl", "cols")))).alias("schema_links"))
    if questions is None:
        return packed
    none = F.from_json(F.lit("{}"), "map<string,array<string>>")
    return (questions.select(*keys).distinct().join(packed, keys, "left")
            .withColumn("schema_links", F.coalesce("schema_links", none)))


def ensemble_search(canon: DataFrame, gold: DataFrame, combos: Sequence[Sequence], questions: DataFrame | None = None,
                    keys: Sequence[str] = ("question_id",), voter: str = "voter",
                    modes: Sequence[str] = MODES, digits: int = 6) -> DataFrame:
    """Score every (combination, mode) cell in one job.

    ``combos`` lists the voters of each combination, the lead first, at most 63 different ones.  One aggregation turns
    the links into a voter bitmask per ``(question, tlc, clc)``, gold is joined once, and a
    question keeps only its counts per ``(level, mask, in gold)``.  Cells are applied to whole batches of those
    counts, and a batch passes on one sum a cell: no row is copied per cell.  Every question of the list counts in
    every cell, also where the cell predicts nothing or gold is empty.
    """
    keys = list(keys)
    voters = sorted({v for c in combos for v in c})
    if len(voters) > 63:
        raise ValueError("a mask holds at most 63 voters")
    bits = {v: 1 << i for i, v in enumerate(voters)}
    bit = F.element_at(F.create_map(*[F.lit(x) for v in voters for x in (v, bits[v])]), F.col(voter)).cast("long")
    on = [*keys, "tlc", "clc"]
    masks = canon.where(F.col(voter).isin(voters)).groupBy(*on).agg(F.bit_or(bit).alias("mask"))
    gk = gold.select(*on).distinct()
    # both sides in one aggregation, which exchanges nothing where they are partitioned by question alike; only links
    # without a null key are matched with gold
    named = gk.where(" and ".join(f"{k} is not null" for k in on)).withColumn("_g", F.lit(True))
    hits = (masks.unionByName(named, allowMissingColumns=True).groupBy(*on)
            .agg(F.max("mask").alias("mask"), F.coalesce(F.max("_g"), F.lit(False)).alias("g")).where("mask is not null"))
    per_mask = hits.groupBy(*keys, (F.col("clc") == "").alias("t"), "mask", "g") \
        .agg(F.count(F.lit(1)).alias("n"))
    found = per_mask.groupBy(*keys).agg(F.collect_list(F.struct("t", "mask", "g", "n")).alias("found"))
    gcount = gk.groupBy(*keys).agg(F.count(F.when(F.col("clc") == "", 1)).alias("n_gold_t"),
                                   F.count(F.when(F.col("clc") != "", 1)).alias("n_gold_c"))
    ids = (gold if questions is None else questions).select(*keys).distinct()
    per = ids.join(gcount, keys, "left").na.fill(0, ["n_gold_t", "n_gold_c"]).join(found, keys, "left")
    cells = [("+".join(map(str, c)), m, sum(bits[v] for v in c), 1 if m == "union" else 2, bits[c[0]] if m == "maj2_or_lead" else 0)
             for c in combos for m in modes]
    sums = per.select("n_gold_t", "n_gold_c", "found").mapInArrow(_score_cells(cells), "combo string, mode string, n long, ts double, cs double")
    cell = sums.groupBy("combo", "mode").agg((F.sum("ts") / F.sum("n") / 3.0).alias("ts"), (F.sum("cs") / F.sum("n") / 3.0).alias("cs"))
    return cell.select("combo", "mode", F.round("ts", digits).alias("table_score"),
                       F.round("cs", digits).alias("column_score"),
                       F.round(0.5 * F.col("ts") + 0.5 * F.col("cs"), digits).alias("leaderboard"))


def _prf_sum(tp: np.ndarray, n_pred: np.ndarray, n_gold: np.ndarray) -> float:
    """The sum of precision, recall and F1 over questions, with the rules for empty sets of ``evaluate.prf``."""
    p = np.where(n_pred > 0, tp / np.maximum(n_pred, 1), np.where(n_gold == 0, 1.0, 0.0))
    r = np.where(n_gold > 0, tp / np.maximum(n_gold, 1), 1.0)
    f = np.where(p + r > 0, 2 * p * r / np.where(p + r > 0, p + r, 1), 0.0)
    return float((p + r + f).sum())


def _score_cells(cells: Sequence[tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            found = batch.column("found")
            question = np.repeat(np.arange(len(batch)), np.array(found.value_lengths().fill_null(0)))
            table, mask, in_gold, n = (found.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(4))
            golds = [batch.column(c).to_numpy() for c in ("n_gold_t", "n_gold_c")]
            out = []
            for combo, mode, members, need, lead in cells:
                voted = mask & np.int64(members)
                kept = (np.bitwise_count(voted) >= need) | ((voted & np.int64(lead)) != 0)
                sums = []
                for level, n_gold in zip((table, ~table), golds):
                    def total(which: np.ndarray) -> np.ndarray:
                        return np.bincount(question[which], n[which], len(batch))
                    sums.append(_prf_sum(total(kept & level & in_gold), total(kept & level), n_gold))
                out.append((combo, mode, len(batch), *sums))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["combo", "mode", "n", "ts", "cs"])
    return run


def top_cells(search: DataFrame, n: int = 10) -> DataFrame:
    """The n best cells (score desc, ties by name) with the running best score."""
    from pyspark.sql import Window
    top = search.orderBy(F.desc("leaderboard"), "combo", "mode").limit(n)
    w = Window.orderBy(F.desc("leaderboard"), "combo", "mode")
    return (top.withColumn("position", F.row_number().over(w))
            .withColumn("running_best", F.max("leaderboard").over(w.rowsBetween(Window.unboundedPreceding, 0))))
