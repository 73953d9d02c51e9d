"""The corpus pipeline: documents whose language is known, one of each group of near copies, personal data
replaced, sources mixed to their targets, packed into training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read again as the
next one's ``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkspark.llm.best_fit_packing import pack, tokenizer_path, with_digest
from linkspark.llm.common import materialise, neutral_names, read
from linkspark.llm.jaccard_join import keep_one
from linkspark.llm.language_codes import fit, predict, with_letter
from linkspark.llm.pii_anchors import redact
from linkspark.llm.source_mix import mix

#: Near copies in the pipeline: five words and a similarity of 0.8 or more.
WORDS, PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, and texts between two languages, go.  Where no row has a language to learn from,
    no text lies between two, so every text with a letter stays."""
    plain = neutral_names(docs, ("doc_id", "text"))
    model = fit(docs)
    known = predict(plain, model).where("lang_pred != 'und' and not lang_ambiguous") if model else with_letter(plain)
    return known.select(plain.columns).toDF(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return keep_one(docs, WORDS, PERCENT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; every document stays."""
    return redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the mix takes them."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    return with_digest(pack(docs, tokenizer_path()))


STAGES = [("language", language), ("near_copies", near_copies), ("personal_data", personal_data),
          ("source_mix", source_mix), ("packing", packing)]

#: SQL can express neither the learned stage nor tokenising; tests/llm/test_pipeline.py goes stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
