"""Set containment (B15): which catalog columns have all their words in a question.

A column's word set is filed under its rarest word, counted within its database.  A question can only contain the
sets filed under its own words, so it meets those few sets instead of every column, and each is verified
rarest word first, where most of them fail at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import meaningful_tokens


def containment_index(columns: DataFrame, scope: Sequence[str] = ("db_id",), text: str = "col", min_tokens: int = 2) -> DataFrame:
    """``columns`` whose ``text`` has at least ``min_tokens`` meaningful words, with ``anchor``, the rarest of
    them, ``second``, the next (null if there is none), and ``rest``, the others."""
    scope = list(scope)
    cols = columns.withColumn("tokens", meaningful_tokens(text)).where(F.size("tokens") >= min_tokens)
    names = columns.columns
    each = cols.select(*names, F.explode_outer("tokens").alias("token"))
    df = each.groupBy(*scope, "token").agg(F.count(F.lit(1)).alias("df"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("df", "token"))), lambda x: x["token"])
    filed = each.join(df, [*scope, "token"]).groupBy(*names).agg(ordered.alias("tokens"))
    return filed.select(*names, F.col("tokens")[0].alias("anchor"), F.get("tokens", F.lit(1)).alias("second"),
                        F.slice("tokens", 3, F.greatest(F.size("tokens") - 2, F.lit(0))).alias("rest"))


def others_within(asked: Column) -> Column:
    """Are a set's words beside its anchor among ``asked``?  Most sets have two words, and need one look."""
    second, rest = F.col("second"), F.col("rest")
    return (second.isNull() | F.array_contains(asked, second)) & ((F.size(rest) == 0) | (F.size(F.array_except(rest, asked)) == 0))


def contained(asked: DataFrame, index: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``asked`` (with ``asked``, an array of distinct words) joined with the sets of ``index`` that they
    contain, both alike in ``on``."""
    each = asked.withColumn("anchor", F.explode_outer("asked"))
    return each.join(index, [*on, "anchor"]).where(others_within(F.col("asked"))).drop("anchor", "second", "rest")
