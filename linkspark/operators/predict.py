"""Predictors over questions (U1): any Python callable over Arrow batches, and the two built-in ones.

A predictor gives exactly one row per question, ``question_id, schema_links`` (JSON text)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import meaningful_tokens
from ..plans.joins import broadcast_if_small, written
from . import render as RD
from . import retrieve as RT
from .contain import contained, containment_index


def mock_predictor(batch: pd.DataFrame) -> pd.DataFrame:
    """An empty link set for every question."""
    return pd.DataFrame({"question_id": batch["question_id"], "schema_links": ["{}"] * len(batch)})


def predict(questions: DataFrame, predictor: Callable[[pd.DataFrame], pd.DataFrame] = mock_predictor) -> DataFrame:
    """Apply ``predictor`` to Arrow batches of questions."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield predictor(batch)
    return questions.mapInPandas(run, "question_id long, schema_links string")


def predict_lexical(questions: DataFrame, columns: DataFrame, k: int, min_tokens: int = 2) -> DataFrame:
    """The ``k`` best tables of the question's database by BM25, of those with a score above 0, each with the
    columns all of whose words the question has.  ``questions (question_id, db_id, question)``, ids unique, and
    ``columns (db_id, table_idx, tbl, col)``."""
    words = F.array_join(F.transform(F.array_sort(F.collect_list("col")), lambda c: c), " ")
    tables = columns.groupBy("db_id", "table_idx", "tbl").agg(words.alias("cols")).select(
        "db_id", "table_idx", "tbl", F.concat_ws(" ", "tbl", "cols").alias("text"))
    scores = RT.bm25(questions, tables)
    best = RT.best_of(scores, k)
    named = best.join(broadcast_if_small(tables.select("db_id", "table_idx", "tbl")), ["db_id", "table_idx"])
    asked = questions.select("question_id", meaningful_tokens("question").alias("asked"))
    index = written(containment_index(columns.select("db_id", "table_idx", "tbl", "col").distinct(), min_tokens=min_tokens).drop("tbl"), "index")
    extra = contained(named.join(asked, "question_id"), broadcast_if_small(index), ["db_id", "table_idx"])
    tlc = F.lower("tbl").alias("tlc")
    links = named.select("question_id", tlc, "tbl", F.lit(None).cast("string").alias("col")).unionByName(
        extra.select("question_id", tlc, "tbl", "col"))
    return questions.select("question_id").join(RD.canonical_target(links), "question_id", "left").select(
        "question_id", F.coalesce("target", F.lit("{}")).alias("schema_links"))
