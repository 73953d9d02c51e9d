"""Ranked retrieval without scoring every match.

The index is written once.  A posting's impact is its whole BM25 share but for the question's term count, so it does not
depend on the question.  ``blocks`` holds the postings of a term in blocks of like impact with the largest impact of
each; ``forward`` holds the same impacts by document.  A question then goes three steps:

1. *Threshold.*  Its blocks with the largest impacts, about ``SEED`` postings, are added up by document; the k-th
   best of these partial scores is a floor for the k-th best score.
2. *Candidates.*  Terms whose largest shares together stay below the floor cannot lift a document to it alone and are left
   out, and so is every block that stays below the floor even with the largest shares of all other terms.  A document
   stays a candidate if its partial score and the largest shares of what was left out reach the floor.
3. *Scores.*  Only candidates are scored in full, from ``forward``.

The result is that of scoring every match, ties included: bounds keep a margin over the rounding of scores.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import tokenize
from ..plans.joins import spread
from .retrieve import B, K1, question_terms

BLOCK = 64         # postings a block holds, about
LEVELS = 4         # impact levels to a unit of impact
SEED = 4096        # postings that set the threshold
BROADCAST_TERMS = 500_000  # a vocabulary of so many terms goes to all tasks
MARGIN = 1e-8      # scores are rounded to nine digits before they are ranked

FORWARD = "corpus string, doc long, term string, impact double"


@dataclass
class Index:
    """Where the tables of an index are."""

    spark: SparkSession
    path: str

    @property
    def blocks(self) -> DataFrame:
        """``corpus, term, level, part, n, largest, postings (doc, impact)``"""
        return self.spark.read.parquet(f"{self.path}/blocks")

    @property
    def forward(self) -> DataFrame:
        """``corpus, doc, term, impact``"""
        return self.spark.read.parquet(f"{self.path}/forward")


def build_index(docs: DataFrame, path: str, corpus: str = "db_id", doc: str = "table_idx", text: str = "text",
                vocabulary: DataFrame | None = None, k1: float = K1, b: float = B) -> Index:
    """Write the index of ``docs`` below ``path``; with ``vocabulary (corpus, term)`` only of those terms.
    Texts are tokenised twice, for lengths and for terms, and not kept; a posting list is cut into blocks by impact and a hash of the document, so no
    term is collected whole."""
    spark = docs.sparkSession
    toks = spread(docs.select(F.col(corpus).cast("string").alias("corpus"), F.col(doc).cast("long").alias("doc"), F.col(text).alias("text")))
    toks = toks.select("corpus", "doc", tokenize("text").alias("toks"))
    stats = toks.groupBy("corpus").agg(F.count(F.lit(1)).alias("n_docs"), F.avg(F.size("toks")).alias("avgdl"))
    # the outer form, since a filter on the array would tokenise once more
    each = toks.select("corpus", "doc", F.size("toks").alias("len"), F.explode_outer("toks").alias("term"))
    if vocabulary is not None:
        vocabulary.select(F.col("corpus").cast("string").alias("corpus"), "term").distinct().write.parquet(f"{path}/vocabulary")
        wanted = spark.read.parquet(f"{path}/vocabulary")
        each = each.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_TERMS else wanted, ["corpus", "term"], "left_semi")
    (each.where(F.col("term").isNotNull()).groupBy("corpus", "doc", "term")
     .agg(F.count(F.lit(1)).alias("f"), F.first("len").alias("len")).write.parquet(f"{path}/counts"))
    counts = spark.read.parquet(f"{path}/counts")
    df = counts.groupBy("corpus", "term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1.0 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    share = F.col("f") * (k1 + 1) / (F.col("f") + k1 * (1 - b + b * F.greatest(F.lit(1), F.col("len")) / F.col("avgdl")))
    (counts.join(df.join(stats, "corpus").select("corpus", "term", "df", "avgdl", idf.alias("idf")), ["corpus", "term"])
     .select("corpus", "doc", "term", (F.col("idf") * share).alias("impact"), "df").write.parquet(f"{path}/forward"))
    forward = spark.read.parquet(f"{path}/forward")
    level = F.floor(F.col("impact") * LEVELS).cast("int")
    part = F.pmod(F.xxhash64("doc"), F.ceil(F.col("df") / BLOCK)).cast("int")
    (forward.groupBy("corpus", "term", level.alias("level"), part.alias("part"))
     .agg(F.count(F.lit(1)).alias("n"), F.max("impact").alias("largest"), F.collect_list(F.struct("doc", "impact")).alias("postings"))
     .write.parquet(f"{path}/blocks"))
    return Index(spark, path)


def _add_up(blocks: DataFrame) -> DataFrame:
    """Partial scores ``qid, doc, partial`` of blocks with ``qid, qf, postings``."""
    return (blocks.select("qid", "qf", F.explode("postings").alias("p"))
            .groupBy("qid", F.col("p.doc").alias("doc")).agg(F.sum(F.col("qf") * F.col("p.impact")).alias("partial")))


def _kth(partial: DataFrame, k: int) -> DataFrame:
    """``qid, floor``: each question's k-th largest partial score."""
    w = Window.partitionBy("qid").orderBy(F.desc("partial"))
    return (partial.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)
            .groupBy("qid").agg(F.min(F.when(F.col("r") == k, F.col("partial"))).alias("floor")))


def _sum_if(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0.0)))


def ranked_scores(questions: DataFrame, index: Index, k: int, scratch: str, qid: str = "question_id", corpus: str = "db_id",
                  text: str = "question", doc: str = "table_idx") -> DataFrame:
    """``qid, corpus, doc, score`` of every document that may be among a question's ``k`` best with a score above 0, a
    superset of them and no more; tables in between go below ``scratch``."""
    spark = index.spark

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")

    qt = keep(question_terms(questions, qid, corpus, text).withColumn("corpus", F.col("corpus").cast("string")), "terms")
    # what each question may gain from each block, without the postings
    heads = keep(index.blocks.select("corpus", "term", "level", "part", "n", "largest").join(qt, ["corpus", "term"])
                 .withColumn("gain", F.col("qf") * F.col("largest")), "heads")
    best_first = Window.partitionBy("qid").orderBy(F.desc("gain"), "term", "level", "part")
    seen = F.sum("n").over(best_first.rowsBetween(Window.unboundedPreceding, -1))
    seeds = heads.withColumn("seen", F.coalesce(seen, F.lit(0))).where(F.col("seen") < SEED)
    block = ["corpus", "term", "level", "part"]
    with_postings = lambda h: h.select("qid", "qf", *block).join(index.blocks.select(*block, "postings"), block)
    floor = keep(_kth(_add_up(with_postings(seeds)), k), "floor")
    # terms from the least gain up, and what all terms up to each gain together
    terms = heads.groupBy("qid", "term").agg(F.max("gain").alias("most"))
    up = Window.partitionBy("qid").orderBy("most", "term")
    terms = terms.join(floor, "qid", "left").select(
        "qid", "term", "most", (F.coalesce("floor", F.lit(0.0)) - MARGIN).alias("floor"), F.sum("most").over(up).alias("upto"),
        F.sum("most").over(Window.partitionBy("qid")).alias("all"))
    judged = heads.join(terms, ["qid", "term"]).withColumn(
        "kept", (F.col("upto") >= F.col("floor")) & (F.col("gain") + F.col("all") - F.col("most") >= F.col("floor")))
    judged = keep(judged, "judged")
    # a document has one posting a term, so what was left out of a term adds its largest such block at most
    left_out = (judged.groupBy("qid", "term").agg(F.max(F.when(~F.col("kept"), F.col("gain"))).alias("gain"))
                .groupBy("qid").agg(F.coalesce(F.sum("gain"), F.lit(0.0)).alias("left_out")))
    partial = keep(_add_up(with_postings(judged.where("kept"))), "partial")
    bar = (left_out.join(_kth(partial, k), "qid", "left").join(floor.withColumnRenamed("floor", "first"), "qid", "left")
           .select("qid", "left_out", F.greatest(F.coalesce("floor", F.lit(0.0)), F.coalesce("first", F.lit(0.0))).alias("floor")))
    candidates = partial.join(bar, "qid").where(F.col("partial") + F.col("left_out") >= F.col("floor") - MARGIN).select("qid", "doc")
    found = keep(candidates, "candidates")
    of = qt.select("qid", "corpus").distinct()
    scored = (found.join(of, "qid").join(index.forward.select("corpus", "doc", "term", "impact"), ["corpus", "doc"])
              .join(qt, ["qid", "corpus", "term"]))
    return scored.groupBy("qid", "corpus", "doc").agg(F.sum(F.col("qf") * F.col("impact")).alias("score")).select(
        F.col("qid").alias(qid), F.col("corpus").alias(corpus), F.col("doc").alias(doc), "score")


def postings_read(scratch: str, index: Index, blocks: Sequence[str] = ("corpus", "term", "level", "part")) -> int:
    """How many postings the candidates step of a run added up."""
    return index.spark.read.parquet(f"{scratch}/judged").where("kept").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
