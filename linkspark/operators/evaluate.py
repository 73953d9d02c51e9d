"""Score predicted links against gold with set precision / recall / F1.

Both sides are in the canonical normal form.  One aggregation of both sides on
``(question, tlc, clc)`` marks every identifier as tp / fp / fn for the table
level (``clc = ''``) and the column level in the same pass; one aggregation per
question turns the flags into P / R / F1; the macro average is a single global
aggregate.  No step collects a question's links or ships rows to the driver.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small

METRICS = ("p_t", "r_t", "f1_t", "p_c", "r_c", "f1_c")


def _flags(pred: DataFrame, gold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each identifier once, with the sides that name it.  Sides that are partitioned by a question alike are not
    exchanged; identifiers with a null key match nothing."""
    on = [*keys, "tlc", "clc"]
    both = pred.select(*on, F.lit(True).alias("in_pred"), F.lit(False).alias("in_gold")).unionByName(
        gold.select(*on, F.lit(False).alias("in_pred"), F.lit(True).alias("in_gold")))
    return (both.groupBy(*on, F.when(_any_null(on), F.col("in_pred")).alias("_side"))
            .agg(F.max("in_pred").alias("in_pred"), F.max("in_gold").alias("in_gold")).drop("_side"))


def _any_null(keys: Sequence[str]) -> Column:
    return functools.reduce(operator.or_, [F.col(k).isNull() for k in keys])


def _cnt(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def set_counts(pred: DataFrame, gold: DataFrame, keys: Sequence[str] = ("question_id",)) -> DataFrame:
    """Per question: sizes of pred, gold and their intersection at both levels (F1 of §2.6)."""
    keys = list(keys)
    f = _flags(pred, gold, keys)
    t = F.col("clc") == ""
    c = ~t
    return f.groupBy(*keys).agg(
        _cnt(t & F.col("in_pred")).alias("n_pred_t"), _cnt(t & F.col("in_gold")).alias("n_gold_t"),
        _cnt(t & F.col("in_pred") & F.col("in_gold")).alias("tp_t"),
        _cnt(c & F.col("in_pred")).alias("n_pred_c"), _cnt(c & F.col("in_gold")).alias("n_gold_c"),
        _cnt(c & F.col("in_pred") & F.col("in_gold")).alias("tp_c"))


def prf(tp: Column, n_pred: Column, n_gold: Column) -> tuple[Column, Column, Column]:
    """D8 boundary rules: pred∅&gold∅ → 1,1,1; pred∅ → 0,0,0; gold∅ → 0,1,0."""
    p = F.when(n_pred == 0, F.when(n_gold == 0, F.lit(1.0)).otherwise(F.lit(0.0))) \
        .otherwise(tp.cast("double") / n_pred)
    r = F.when(n_gold == 0, F.lit(1.0)).otherwise(tp.cast("double") / n_gold)
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return p, r, f1


def per_question_scores(pred: DataFrame, gold: DataFrame, questions: DataFrame | None = None,
                        keys: Sequence[str] = ("question_id",), predicted: DataFrame | None = None) -> DataFrame:
    """C3 + D8: one metric row per *evaluated* question.

    ``questions`` lists the ids that have a gold record (default: those of ``gold``), also
    those whose gold is empty or wholly invalid; a question without predictions scores as
    empty; predictions for other questions are ignored (C4 reports them).  ``predicted``
    lists the ids that have a prediction record, empty or not (default: those of ``pred``);
    ``missing_prediction`` is true for the others.
    """
    keys = list(keys)
    # one aggregation of all three, so that sides partitioned by a question alike stay in place; null keys match nothing
    flag = lambda df, name: df.select(*keys, F.lit(True).alias(name))
    known = lambda df: df.where(~_any_null(keys))
    sides = (flag(gold if questions is None else questions, "_id")
             .unionByName(known(flag(pred if predicted is None else predicted, "_given")), allowMissingColumns=True)
             .unionByName(known(set_counts(pred, gold, keys)), allowMissingColumns=True))
    sizes = ("n_pred_t", "n_gold_t", "tp_t", "n_pred_c", "n_gold_c", "tp_c")
    counts = sides.groupBy(*keys).agg(F.max("_id").alias("_id"), F.max("_given").alias("_given"),
                                      *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sizes]).where("_id")
    p_t, r_t, f1_t = prf(F.col("tp_t"), F.col("n_pred_t"), F.col("n_gold_t"))
    p_c, r_c, f1_c = prf(F.col("tp_c"), F.col("n_pred_c"), F.col("n_gold_c"))
    return counts.select(*keys, p_t.alias("p_t"), r_t.alias("r_t"), f1_t.alias("f1_t"),
                         p_c.alias("p_c"), r_c.alias("r_c"), f1_c.alias("f1_c"),
                         F.col("_given").isNull().alias("missing_prediction"))


def question_status(questions: DataFrame, catalog: DataFrame, gold_ids: DataFrame, predicted: DataFrame,
                    keys: Sequence[str] = ("question_id",), scope: Sequence[str] = ("db_id",)) -> DataFrame:
    """What becomes of each of ``questions(keys, scope)``: ``missing_schema`` where the catalog lacks its
    database, else ``missing_gold`` where it has no gold record, else ``scored``; ``missing_prediction`` is true for
    scored questions without a prediction record, which count as empty."""
    keys, scope = list(keys), list(scope)
    flag = lambda df, on, name: df.select(*on).distinct().withColumn(name, F.lit(True))
    q = questions.select(*dict.fromkeys([*keys, *scope])).distinct()
    j = (q.join(broadcast_if_small(flag(catalog, scope, "_schema")), scope, "left")
         .join(flag(gold_ids, keys, "_gold"), keys, "left").join(flag(predicted, keys, "_given"), keys, "left"))
    status = (F.when(F.col("_schema").isNull(), "missing_schema").when(F.col("_gold").isNull(), "missing_gold")
              .otherwise("scored"))
    return j.select(*q.columns, status.alias("status"),
                    ((status == "scored") & F.col("_given").isNull()).alias("missing_prediction"))


def evaluation_report(pred: DataFrame, gold: DataFrame, status: DataFrame, predicted: DataFrame,
                      by: Sequence[str] = ("dataset",), keys: Sequence[str] = ("question_id",)) -> DataFrame:
    """C3, C4, D9 in one row for each prediction file (``by``): macro averages over the scored questions, and how many
    questions were skipped without a schema or without gold, scored as empty, or predicted without being asked.
    ``status`` comes from :func:`question_status` with ``keys`` and ``by`` as its keys."""
    on, by = [*keys, *by], list(by)
    scores = per_question_scores(pred, gold, status.where("status = 'scored'"), on, predicted)
    means = scores.groupBy(*by).agg(*[F.avg(m).alias(m) for m in METRICS])
    counts = status.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_questions"),
        *[_cnt(F.col("status") == s).alias(f"n_{s}") for s in ("scored", "missing_gold", "missing_schema")],
        _cnt(F.col("missing_prediction")).alias("n_missing_prediction"))
    extra = extra_predictions(predicted, status, on).groupBy(*by).agg(F.count(F.lit(1)).alias("n_extra"))
    out = counts.join(means, by, "left").join(extra, by, "left").withColumn("n_extra", F.coalesce("n_extra", F.lit(0)))
    score = (sum(F.col(m) for m in METRICS[:3]) + sum(F.col(m) for m in METRICS[3:])) / 6.0
    return out.withColumn("leaderboard", score)


def leaderboard(per_question: DataFrame, digits: int = 6) -> DataFrame:
    """Macro averages, table / column scores and 0.5·T + 0.5·C, one row."""
    agg = per_question.agg(F.count(F.lit(1)).alias("n_questions"),
                           *[F.avg(m).alias(m) for m in METRICS])
    ts = (F.col("p_t") + F.col("r_t") + F.col("f1_t")) / 3.0
    cs = (F.col("p_c") + F.col("r_c") + F.col("f1_c")) / 3.0
    out = agg.select("n_questions", *METRICS, ts.alias("table_score"), cs.alias("column_score"))
    out = out.withColumn("leaderboard", 0.5 * F.col("table_score") + 0.5 * F.col("column_score"))
    return out.select("n_questions", *[F.round(c, digits).alias(c) for c in out.columns[1:]])


def extra_predictions(pred_ids: DataFrame, questions: DataFrame,
                      keys: Sequence[str] = ("question_id",)) -> DataFrame:
    """C4: prediction ids not in the question set (ignored by scoring, reported)."""
    keys = list(keys)
    return pred_ids.select(*keys).distinct().join(questions.select(*keys).distinct(), keys, "left_anti")


def prediction_diff(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("question_id",)) -> DataFrame:
    """Full outer compare of two link sets -> counts of only-left / only-right / both."""
    f = _flags(a, b, keys)
    return f.agg(_cnt(F.col("in_pred") & ~F.col("in_gold")).alias("only_left"),
                 _cnt(~F.col("in_pred") & F.col("in_gold")).alias("only_right"),
                 _cnt(F.col("in_pred") & F.col("in_gold")).alias("both"))


def miss_attribution(pred: DataFrame, gold: DataFrame, group: DataFrame, group_col: str,
                     keys: Sequence[str] = ("question_id",)) -> DataFrame:
    """Missed gold tables (false negatives) per group and their share of all misses."""
    keys = list(keys)
    f = _flags(pred, gold, keys).where((F.col("clc") == "") & F.col("in_gold") & ~F.col("in_pred"))
    g = broadcast_if_small(group.select(*keys, group_col))
    per = f.join(g, keys).groupBy(group_col).agg(F.count(F.lit(1)).alias("missed_tables"))
    from pyspark.sql import Window
    total = F.sum("missed_tables").over(Window.partitionBy())
    return per.withColumn("share", F.round(F.col("missed_tables") / total, 6))


def last_wins(records: DataFrame, order: Sequence[str], keys: Sequence[str] = ("question_id",)) -> DataFrame:
    """Of the records of a key the last by ``order`` (a file's place, or the columns that say it), with all its
    columns, and ``n_duplicates``, how many came before it."""
    keys = list(keys)
    rest = [c for c in records.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return records.groupBy(*keys).agg(last, (F.count(F.lit(1)) - 1).alias("n_duplicates")).select(*keys, "_last.*", "n_duplicates")
