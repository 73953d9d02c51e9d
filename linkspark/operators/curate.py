"""Curate synthetic training data: validate, de-duplicate, cap, number, sample, profile
(E5-E8, F3, D11, D12, B15, B17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small


def class_balance(links: DataFrame, groups: DataFrame, group_col: str, digits: int = 6,
                  keys: Sequence[str] = ("question_id",)) -> DataFrame:
    """Examples per group, examples using a table with no column ("wildcard"), share."""
    keys = list(keys)
    per_t = links.groupBy(*keys, "tlc").agg(
        F.count(F.when(F.col("clc") != "", 1)).alias("n_cols"))
    per_q = per_t.groupBy(*keys).agg(F.max((F.col("n_cols") == 0).cast("int")).alias("wildcard"))
    per = (per_q.join(groups.select(*keys, group_col), keys)
           .groupBy(group_col).agg(F.count(F.lit(1)).alias("n_examples"),
                                   F.sum("wildcard").cast("long").alias("n_wildcard")))
    # the per-group result has one row per group: a single-partition window over it is bounded
    total = F.sum("n_examples").over(Window.partitionBy())
    return per.withColumn("share", F.round(F.col("n_examples") / total, digits))


# ---------------------------------------------------------------- E5 / E6 / E7 / F3 / D11

# fixed values: the statuses of the audit
STATUS_OK = "ok"
STATUS_EMPTY = "empty_question_or_sql"
STATUS_DUPLICATE = "duplicate_question"
STATUS_PARSE = "parse_error"
STATUS_NO_TABLES = "zero_recognized_tables"
STATUS_OVER_LIMIT = "over_limit"  # own status: beyond the caller's limit, kept in the audit


def strip_ws(c):
    """Strip surrounding ASCII whitespace, all kinds of it."""
    return F.trim(F.coalesce(c, F.lit("")), F.lit(" \t\n\x0b\f\r"))


def normalized_question(col: str = "question"):
    return F.lower(strip_ws(F.col(col)))




def validate_candidates(cand: DataFrame, existing: DataFrame, order: str = "pos") -> DataFrame:
    """E5: ordered validation of generated candidates.

    Reasons, first match wins: empty question or SQL -> duplicate of an existing
    question or of an *earlier kept* candidate -> parse error -> no recognised table
    -> ok.  The parser's verdict arrives as columns (``parse_failed``, ``n_tables``).
    "Earlier kept" is resolved without a sequential loop: within a normalised
    question, the first candidate that passes every other check is the one kept;
    all later ones are duplicates.
    """
    c = cand.withColumn("_norm", normalized_question())
    empty = (F.col("_norm") == "") | (strip_ws(F.col("gold_sql")) == "")
    # empty questions get a key of their own each: they match nothing and must not meet in one task
    # and texts are compared by digest, so that no text moves for it
    c = c.withColumn("_empty", empty).withColumn(
        "_norm", F.md5(F.when(F.col("_norm") == "", F.concat(F.lit("\0"), F.col(order).cast("string"))).otherwise(F.col("_norm"))))
    empty, self_ok = F.col("_empty"), ~F.col("_empty") & ~F.col("parse_failed") & (F.col("n_tables") > 0)
    seen = existing.select(F.md5(normalized_question()).alias("_norm")).distinct()
    c = c.join(broadcast_if_small(seen).withColumn("_existing", F.lit(True)), "_norm", "left")
    first_ok = (c.where(self_ok & F.col("_existing").isNull())
                .groupBy("_norm").agg(F.min(order).alias("_first_ok")))
    c = c.join(first_ok, "_norm", "left")
    status = (F.when(empty, F.lit(STATUS_EMPTY))
              .when(F.col("_existing").isNotNull(), F.lit(STATUS_DUPLICATE))
              .when(F.col("_first_ok").isNotNull() & (F.col(order) > F.col("_first_ok")), F.lit(STATUS_DUPLICATE))
              .when(F.col("parse_failed"), F.lit(STATUS_PARSE))
              .when(F.col("n_tables") <= 0, F.lit(STATUS_NO_TABLES))
              .otherwise(F.lit(STATUS_OK)))
    return c.withColumn("status", status).drop("_norm", "_empty", "_existing", "_first_ok")


def cap_per_group(audited: DataFrame, n: int | None = None, group: str = "db_id", order: str = "pos") -> DataFrame:
    """At most ``n`` kept candidates per group (default: no limit).  Candidates after the
    n-th kept one stay in the audit with status ``over_limit``, so its counts add up to the
    input.  The n-th kept position per group comes from a rank-limited window (partial
    top-n before the shuffle)."""
    if n is None:
        return audited
    w = Window.partitionBy(group).orderBy(order)
    kept = (audited.where(F.col("status") == STATUS_OK).select(group, order)
            .withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n))
    last = kept.groupBy(group).agg(F.max(order).alias("_last"), F.count(F.lit(1)).alias("_k"))
    j = audited.join(broadcast_if_small(last), group, "left")
    over = (F.col("_k") == n) & (F.col(order) > F.col("_last"))
    return j.withColumn("status", F.when(over, F.lit(STATUS_OVER_LIMIT)).otherwise(F.col("status"))).drop("_last", "_k")


def assign_ids(kept: DataFrame, existing_ids: DataFrame, gap: int = 700, order: str = "pos",
               id_col: str = "question_id", width: int = 1 << 16) -> DataFrame:
    """Number the survivors from ``max(existing id) + gap`` in candidate order.

    Survivors are numbered within ranges of ``width`` positions, each from the running total
    of the ranges before it; only those totals, one row per range, meet in one task."""
    base = F.coalesce(existing_ids.agg(F.max(id_col)).scalar(), F.lit(0))  # evaluated once
    part = F.floor(F.col(order) / width)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (kept.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
              .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return (kept.withColumn("_part", part).join(totals, "_part")
            .withColumn(id_col, base + gap + F.col("_before") + place).drop("_part", "_before"))


def status_histogram(audited: DataFrame) -> DataFrame:
    """Count per status, most common first."""
    return audited.groupBy("status").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "status")


def fewshot_sample(existing: DataFrame, k: int, group: str = "db_id", family: str = "family",
                   order: str = "pos", targets: DataFrame | None = None) -> DataFrame:
    """K examples per group in a deterministic hash order; a group with fewer than k
    of its own is topped up from its family's other groups.  ``targets(group, family)``
    lists the groups to serve, also those without any example of their own.

    Exact with bounded work: a short group needs at most k siblings, and the family's
    first 2k examples in hash order always contain k from other groups when the
    group owns fewer than k, so only that prefix is joined to short groups.
    """
    # deterministic arithmetic order (Knuth multiplicative hash of the position)
    h = existing.withColumn("_h", F.pmod(F.col(order) * 2654435761, F.lit(4294967296)))
    own = (h.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy("_h", order)))
           .where(F.col("_r") <= k))
    counts = own.groupBy(group, family).agg(F.count(F.lit(1)).alias("_own"))
    if targets is not None:
        counts = (targets.select(group, family).distinct().join(counts, [group, family], "left")
                  .select(group, family, F.coalesce("_own", F.lit(0).cast("long")).alias("_own")))
    prefix = (h.withColumn("_fr", F.row_number().over(Window.partitionBy(family).orderBy("_h", order)))
              .where(F.col("_fr") <= 2 * k)
              .select(F.col(family).alias("_fam"), F.col(group).alias("_src"), F.col(order).alias("_pos"),
                      "_h", "_fr"))
    short = counts.where(F.col("_own") < k)
    sib = (short.join(prefix, (short[family] == prefix["_fam"]) & (short[group] != prefix["_src"]))
           .withColumn("_sr", F.row_number().over(Window.partitionBy(group).orderBy("_fr")))
           .where(F.col("_sr") <= k - F.col("_own"))
           .select(group, F.col("_pos").alias(order), (F.col("_own") + F.col("_sr")).alias("slot")))
    mine = own.select(group, order, F.col("_r").alias("slot"))
    return mine.unionByName(sib)


def rationale_filter(rationales: DataFrame, gold_tables: DataFrame, keys: Sequence[str],
                     max_words: int = 80) -> DataFrame:
    """Keep a rationale when it is non-empty, has at most ``max_words`` whitespace
    words and mentions (case-insensitive substring) at least one gold table name.

    The mention test is a join of the rationale with its own example's gold tables
    (bounded by that example's gold set), not a scan over all names."""
    keys = list(keys)
    r = rationales
    text_lc = F.lower(F.col("text"))
    mentions = (r.join(gold_tables, keys).where(F.contains(text_lc, F.col("t")))
                .select(*keys, "turn").distinct().withColumn("_hit", F.lit(True)))
    from ..functions.text import word_count
    stripped = strip_ws(F.col("text"))
    out = r.join(mentions, [*keys, "turn"], "left")
    keep = (stripped != "") & (word_count("text") <= max_words) & F.coalesce(F.col("_hit"), F.lit(False))
    return out.withColumn("keep", keep).drop("_hit")


def expand_columns(pred: DataFrame, questions: DataFrame, catalog_cols: DataFrame,
                   keys: Sequence[str] = ("question_id",), min_tokens: int = 2,
                   scope: Sequence[str] = ("db_id",)) -> DataFrame:
    """Add a catalog column of a predicted table when it has at least ``min_tokens``
    meaningful tokens and all of them occur in the question; predicted columns stay.

    ``questions`` and ``catalog_cols`` carry ``scope``: a column is looked up in the question's
    own database.  A predicted table meets only those of its columns that are filed under a word of the
    question (``contain.containment_index``).
    """
    from ..functions.text import meaningful_tokens
    from .contain import containment_index, others_within
    keys, scope = list(keys), list(scope)
    asked = questions.select(*dict.fromkeys([*keys, *scope]), meaningful_tokens("question").alias("asked"))
    index = containment_index(catalog_cols.select(*scope, "tlc", "clc", "tbl", "col"), scope, "col", min_tokens)
    link = F.struct("clc", "tbl", "col")
    named = pred.groupBy(*keys, "tlc").agg(F.collect_list(link).alias("links")).join(asked, keys, "left")
    # a table's predicted links pass with a null word, beside the words its columns are looked up by
    words = F.concat(F.array(F.lit(None).cast("string")), F.coalesce("asked", F.array().cast("array<string>")))
    looked_up = named.withColumn("anchor", F.explode(words)).join(broadcast_if_small(index), [*scope, "tlc", "anchor"], "left")
    fresh = others_within(F.col("asked")) & ~F.array_contains(F.col("links")["clc"], F.col("clc"))
    links = F.when(F.col("anchor").isNull(), F.col("links")).when(F.col("clc").isNotNull() & fresh, F.array(link))
    return looked_up.select(*keys, "tlc", F.inline(links)).select(*keys, "tlc", "clc", "tbl", "col")


def sequential_admission(cand: DataFrame, existing: DataFrame, n: int, scratch: str, group: str = "db_id",
                         order: str = "pos") -> DataFrame:
    """E5 and E6 in the order of one pass over the candidates: group by group, in order within a group, a group
    closed once ``n`` of its candidates are kept.  Candidates after that are ``over_limit`` and do not make later
    ones duplicates, in whatever group those are.

    Found without a pass, by rounds: with the closing places of the round before, the first passing candidate of
    each question is kept, and the ``n``-th kept one of each group is where it closes.  Closing places are right
    for one group more after each round, usually for all after a few; rounds work on digests of the passing
    candidates, and only on questions that more than one of them asks, and end when no place moves.
    """
    spark = cand.sparkSession
    empty = (normalized_question("question") == "") | (strip_ws(F.col("gold_sql")) == "")
    c = cand.withColumn("_norm", F.md5(normalized_question("question"))).withColumn("_empty", empty)
    seen = existing.select(F.md5(normalized_question("question")).alias("_norm")).distinct().withColumn("_old", F.lit(True))
    c = c.join(seen, "_norm", "left").withColumn(
        "_passes", ~F.col("_empty") & F.col("_old").isNull() & ~F.col("parse_failed") & (F.col("n_tables") > 0))
    c.where("_passes").select("_norm", group, order).write.parquet(f"{scratch}/passing")
    passing = spark.read.parquet(f"{scratch}/passing")
    shared = passing.groupBy("_norm").agg(F.count(F.lit(1)).alias("_n"))
    once = passing.join(shared.where("_n = 1").select("_norm"), "_norm", "left_semi")
    often = passing.join(shared.where("_n > 1").select("_norm"), "_norm", "left_semi")
    once.write.parquet(f"{scratch}/once")
    often.write.parquet(f"{scratch}/often")
    once, often = (spark.read.parquet(f"{scratch}/{x}") for x in ("once", "often"))
    place = Window.partitionBy(group).orderBy(order)
    schema = f"{group} {cand.schema[group].dataType.simpleString()}, close {cand.schema[order].dataType.simpleString()}"
    close = spark.createDataFrame([], schema)  # a row for each group that closes

    def open_yet(rows: DataFrame, close: DataFrame) -> DataFrame:
        return rows.join(close, group, "left").where(F.col("close").isNull() | (F.col(order) <= F.col("close"))).drop("close")

    round_no = 0
    while True:
        first = open_yet(often, close).groupBy("_norm").agg(F.min(F.struct(group, order)).alias("k")).select("_norm", f"k.{group}", f"k.{order}")
        kept = first.unionByName(open_yet(once, close))
        new = (kept.withColumn("_r", F.row_number().over(place)).where(F.col("_r") == n)
               .select(group, F.col(order).alias("close")))
        new.write.parquet(f"{scratch}/close-{round_no}")
        new = spark.read.schema(schema).parquet(f"{scratch}/close-{round_no}")
        both = new.withColumn("side", F.lit(1)).unionByName(close.withColumn("side", F.lit(-1)))
        still = both.groupBy(group, "close").agg(F.sum("side").alias("d")).where("d != 0").isEmpty()
        close, round_no = new, round_no + 1
        if still:
            break
    first = open_yet(passing, close).groupBy("_norm").agg(F.min(F.struct(group, order)).alias("_first"))
    j = c.join(close, group, "left").join(first, "_norm", "left")
    me = F.struct(F.col(group), F.col(order))
    status = (F.when(F.col(order) > F.col("close"), F.lit(STATUS_OVER_LIMIT))
              .when(F.col("_empty"), F.lit(STATUS_EMPTY))
              .when(F.col("_old").isNotNull() | (F.col("_first") < me), F.lit(STATUS_DUPLICATE))
              .when(F.col("parse_failed"), F.lit(STATUS_PARSE))
              .when(F.col("n_tables") <= 0, F.lit(STATUS_NO_TABLES)).otherwise(F.lit(STATUS_OK)))
    return j.withColumn("status", status).select(*cand.columns, "status")


def length_percentiles(lengths: DataFrame, group: str, shares: Sequence[float], n: str = "n") -> DataFrame:
    """Per group, and over all (``group`` '*'), how many examples, the longest, and exact percentiles (the least
    length that so large a share does not exceed).  Lengths are counted before they are exchanged, so a
    group costs the number of its different lengths."""
    counts = lengths.groupBy(group, F.col(n).alias("_n")).agg(F.count(F.lit(1)).alias("_c"))
    # over all: the same counts with no group of their own; a window's rows are the different lengths of a group
    every = F.array(F.struct(F.lit(False).alias("_all"), F.col(group)), F.struct(F.lit(True).alias("_all"), F.lit(None).alias(group)))
    counts = counts.select(F.inline(every), "_n", "_c").groupBy("_all", group, "_n").agg(F.sum("_c").alias("_c"))
    known = F.when(F.col("_n").isNotNull(), F.col("_c"))
    of = Window.partitionBy("_all", group)
    upto = counts.select("*", F.sum(known).over(of.orderBy("_n")).alias("_upto"), F.sum(known).over(of).alias("_known"))
    each = [F.min(F.when(F.col("_upto") >= F.col("_known") * F.lit(float(q)), F.col("_n"))).cast("long").alias(f"p{round(q * 100):d}_chars") for q in shares]
    return upto.groupBy("_all", group).agg(F.sum("_c").alias("n_examples"), F.max("_n").alias("max_chars"), *each).drop("_all").withColumn(
        group, F.coalesce(group, F.lit("*")))
