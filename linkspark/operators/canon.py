"""Validate and canonicalise schema links against a catalog.

Working form of links (the *normal form* used by every downstream operator):

    keys..., tlc, clc, tbl, col

* ``tlc`` / ``clc`` are the lower-cased table / column keys;
* a *table row* has ``clc = ''`` and ``col = NULL`` and asserts that the table
  is used (the ``{"t": []}`` case); every table that has a column row also has
  exactly one table row, so table-level sets are ``WHERE clc = ''`` and
  column-level sets are ``WHERE clc <> ''``;
* ``tbl`` / ``col`` carry the catalog's spelling.

Every lookup is made in the link's own database: ``scope`` (default ``db_id``) is a
column of both links and catalog, so another database's tables are unknown here and
spelling is that of this database.  The catalog is joined through a size-checked
broadcast; links are never collected.  De-duplication is keyed on ``(question, tlc, clc)`` first so a
question that owns a third of all rows is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from .vote import pack_links

HALLU = "__hallu__:"  # fixed marker for schema-invalid identifiers in graded scoring
NO_COLUMN = ""        # clc of a table row in the normal form
SCOPE = ("db_id",)    # columns of links and catalog that name the database a question is asked of


def _columns(*names: Sequence[str]) -> list[str]:
    """All names once, in order."""
    return list(dict.fromkeys(n for part in names for n in part))


def catalog_tables(catalog: DataFrame, scope: Sequence[str] = SCOPE, tbl: str = "tbl") -> DataFrame:
    """``scope, tlc -> tbl_c`` (one spelling per database and lower-cased table)."""
    return (catalog.where(F.col(tbl).isNotNull())
            .groupBy(*scope, F.lower(tbl).alias("tlc")).agg(F.min(tbl).alias("tbl_c")))


def catalog_columns(catalog: DataFrame, scope: Sequence[str] = SCOPE, tbl: str = "tbl", col: str = "col") -> DataFrame:
    """``scope, tlc, clc -> col_c`` (one spelling per database and lower-cased column of a table)."""
    return (catalog.where(F.col(tbl).isNotNull() & F.col(col).isNotNull() & (F.col(col) != ""))
            .groupBy(*scope, F.lower(tbl).alias("tlc"), F.lower(col).alias("clc"))
            .agg(F.min(col).alias("col_c")))


def _normal_rows(df: DataFrame, keys: Sequence[str], tbl_c: Column, col_c: Column) -> DataFrame:
    """Emit one table row plus (when the column is valid) one column row per input row."""
    null = F.lit(None).cast("string")
    pair = F.struct(tbl_c.alias("tbl"), col_c.alias("col"))
    rows = F.when(col_c.isNull(), F.array(F.struct(tbl_c.alias("tbl"), null.alias("col")))) \
        .otherwise(F.array(F.struct(tbl_c.alias("tbl"), null.alias("col")), pair))
    out = df.select(*keys, F.explode(rows).alias("r"))
    return out.select(*keys,
                      F.lower("r.tbl").alias("tlc"),
                      F.coalesce(F.lower("r.col"), F.lit(NO_COLUMN)).alias("clc"),
                      F.col("r.tbl").alias("tbl"), F.col("r.col").alias("col"))


def canonicalize(links: DataFrame, catalog: DataFrame, keys: Sequence[str] = ("question_id",),
                 tbl: str = "tbl", col: str = "col", partition_keys: Sequence[str] | None = None,
                 scope: Sequence[str] = SCOPE, exchange: bool = True, parts: int | None = None) -> DataFrame:
    """Drop unknown tables (with their columns) and unknown columns, re-case to the
    catalog, merge keys that differ only in case, keep tables whose column list is empty.

    ``links`` holds raw link rows ``keys..., scope..., tbl, col`` (``col`` NULL = table only).
    Returns the normal form, de-duplicated on ``keys + (tlc, clc)`` and hash
    partitioned on ``partition_keys + (tlc, clc)`` (default ``keys``).  Voting passes
    the question keys without the voter so the vote aggregation needs no new exchange.
    ``parts`` is the number of partitions; with ``exchange=False``, for links that come partitioned by their
    keys, they stay where they are.
    """
    keys, scope = list(keys), list(scope)
    tables = broadcast_if_small(catalog_tables(catalog, scope))
    columns = broadcast_if_small(catalog_columns(catalog, scope))
    l = links.select(*_columns(keys, scope), F.lower(tbl).alias("tlc"), F.lower(col).alias("clc"))
    j = l.join(tables, [*scope, "tlc"])  # unknown tables disappear together with their columns
    j = j.join(columns, [*scope, "tlc", "clc"], "left")
    out = _normal_rows(j, keys, F.col("tbl_c"), F.col("col_c"))
    # One exchange on (question keys, tlc, clc); voting and scoring reuse it.
    part = list(partition_keys) if partition_keys is not None else keys
    if exchange:
        out = out.repartition(*([parts] if parts else []), *part, "tlc", "clc")
    return out.dropDuplicates([*keys, "tlc", "clc"])


def graded_links(links: DataFrame, catalog: DataFrame, keys: Sequence[str] = ("question_id",),
                 tbl: str = "tbl", col: str = "col", is_gold: bool = False,
                 scope: Sequence[str] = SCOPE) -> DataFrame:
    """The grader's variant.  Unknown identifiers are *kept* for predictions as
    un-matchable ``__hallu__:`` markers (false positives) and dropped for gold.

    Returns the normal form with ``bad_table`` / ``bad_column`` flags per input row
    (before de-duplication) so that :func:`hallucination_tally` can count them.
    """
    keys, scope = list(keys), list(scope)
    tables = broadcast_if_small(catalog_tables(catalog, scope))
    columns = broadcast_if_small(catalog_columns(catalog, scope))
    l = links.select(*_columns(keys, scope), F.col(tbl).alias("tbl_in"), F.col(col).alias("col_in"),
                     F.lower(tbl).alias("tlc"), F.lower(col).alias("clc"))
    j = l.join(tables, [*scope, "tlc"], "left").join(columns, [*scope, "tlc", "clc"], "left")
    known_t = F.col("tbl_c").isNotNull()
    has_col = F.col("col_in").isNotNull()
    tbl_g = F.when(known_t, F.col("tbl_c")).otherwise(F.concat(F.lit(HALLU), F.col("tlc")))
    col_g = (F.when(~has_col, F.lit(None).cast("string"))
             .when(known_t & F.col("col_c").isNotNull(), F.col("col_c"))
             .otherwise(F.concat(F.lit(HALLU), F.lower("col_in"))))
    j = j.withColumn("bad_table", ~known_t).withColumn(
        "bad_column", has_col & (~known_t | F.col("col_c").isNull()))
    if is_gold:
        j = j.where(known_t).withColumn(
            "col_g_src", F.when(F.col("bad_column"), F.lit(None).cast("string")).otherwise(col_g))
        return _normal_rows(j, keys, F.col("tbl_c"), F.col("col_g_src"))
    return j.select(*keys, "tbl_in", "bad_table", "bad_column", tbl_g.alias("tbl_g"), col_g.alias("col_g"))


def graded_normal_form(graded: DataFrame, keys: Sequence[str] = ("question_id",)) -> DataFrame:
    """Normal form of :func:`graded_links` output (markers included), de-duplicated."""
    keys = list(keys)
    out = _normal_rows(graded, keys, F.col("tbl_g"), F.col("col_g"))
    return out.dropDuplicates([*keys, "tlc", "clc"])


def hallucination_tally(graded: DataFrame, pred_keys: Sequence[str] = ("question_id",),
                        by: Sequence[str] = ()) -> DataFrame:
    """Count schema-invalid identifiers as the grader reports them.

    A bad table counts once per distinct key spelling within one prediction
    (``pred_keys``); a bad column counts once per occurrence (duplicates included,
    every column listed under a bad table included).
    """
    bad_t = F.when(F.col("bad_table"), F.struct(*[F.col(k) for k in pred_keys], F.col("tbl_in")))
    return graded.groupBy(*by).agg(
        F.count_distinct(bad_t).alias("bad_tables"),
        F.coalesce(F.sum(F.col("bad_column").cast("long")), F.lit(0)).alias("bad_columns"))


def two_stage_merge(stage_a: DataFrame, stage_b: DataFrame, catalog: DataFrame,
                    keys: Sequence[str] = ("question_id",), tbl: str = "tbl", col: str = "col",
                    scope: Sequence[str] = SCOPE) -> DataFrame:
    """Merge a table-stage and a column-stage prediction.

    Only catalog tables named by stage A survive (re-cased, de-duplicated); stage-B
    columns survive when the column exists in a surviving table.  A surviving table
    without valid columns keeps an empty list (its table row only).
    """
    keys, scope = list(keys), list(scope)
    own = _columns(keys, scope)
    tables = broadcast_if_small(catalog_tables(catalog, scope))
    columns = broadcast_if_small(catalog_columns(catalog, scope))
    a = (stage_a.select(*own, F.lower(tbl).alias("tlc")).join(tables, [*scope, "tlc"])
         .dropDuplicates([*own, "tlc"]))
    b = (stage_b.select(*own, F.lower(tbl).alias("tlc"), F.lower(col).alias("clc"))
         .join(columns, [*scope, "tlc", "clc"]).dropDuplicates([*own, "tlc", "clc"]))
    b = b.join(a, [*own, "tlc"])
    null = F.lit(None).cast("string")
    t_rows = a.select(*keys, "tlc", F.lit(NO_COLUMN).alias("clc"), F.col("tbl_c").alias("tbl"), null.alias("col"))
    c_rows = b.select(*keys, "tlc", "clc", F.col("tbl_c").alias("tbl"), F.col("col_c").alias("col"))
    return t_rows.unionByName(c_rows)


def resolve_mentions(mentions: DataFrame, catalog: DataFrame, qid: str = "query_id",
                     scope: Sequence[str] = SCOPE) -> DataFrame:
    """Turn extracted SQL mentions into links.

    ``mentions(qid, scope..., alias, tbl, col_alias, col)``: one row per table mention (with
    its alias, if any) and column mention (qualifier may be NULL; ``*`` names no column).
    Every mentioned catalog table is a link even without columns; a qualified column
    resolves through the query's aliases and the tables' own names; a bare column resolves to
    its unique owner among the query's tables (ambiguous or unknown mentions are dropped).  Mentions that come partitioned
    by ``qid`` are resolved where they are.
    """
    scope = list(scope)
    own = _columns([qid], scope)
    tables = broadcast_if_small(catalog_tables(catalog, scope))
    columns = broadcast_if_small(catalog_columns(catalog, scope))
    named = (mentions.select(*own, F.lower("tbl").alias("tlc")).join(tables, [*scope, "tlc"])
             .dropDuplicates([*own, "tlc"]))
    # what a name stands for and what it qualifies meet in one group a name; bare columns and tables in the group without one
    word = lambda c: F.lower(c) if isinstance(c, str) else F.lit(None).cast("string")
    entry = lambda name, tlc, clc: F.struct(word(name).alias("name"), word(tlc).alias("tlc"), word(clc).alias("clc"))
    said = F.when(F.col("col") != "*", F.array(entry("col_alias", None, "col")))
    entries = F.concat(F.filter(F.array(entry("alias", "tbl", None), entry("tbl", "tbl", None)), lambda e: e["name"].isNotNull()),
                       F.array(entry(None, "tbl", None)), F.coalesce(said, F.array().cast("array<struct<name:string,tlc:string,clc:string>>")))
    met = (mentions.where(" and ".join(f"`{k}` is not null" for k in own)).select(*own, F.explode(entries).alias("e"))
           .groupBy(*own, F.col("e.name").alias("name")).agg(F.collect_set("e.tlc").alias("t"), F.collect_set("e.clc").alias("c")))
    pairs = (met.select(*own, F.col("name").isNull().alias("bare"), F.explode("c").alias("clc"), "t")
             .select(*own, "bare", "clc", F.explode("t").alias("tlc")).join(columns, [*scope, "tlc", "clc"]))
    # a qualified pair counts as it is, a bare column if it has one owner
    owner = F.when(~F.col("bare"), F.col("tlc"))
    owned = (pairs.groupBy(*own, "bare", "clc", owner.alias("owner")).agg(
                F.count(F.lit(1)).alias("owners"), F.min("tlc").alias("tlc"), F.min("col_c").alias("col_c"))
             .where("owners = 1 or not bare"))
    cols = owned.join(tables, [*scope, "tlc"]).dropDuplicates([*own, "tlc", "clc"])
    null = F.lit(None).cast("string")
    t_rows = named.select(qid, "tlc", F.lit(NO_COLUMN).alias("clc"), F.col("tbl_c").alias("tbl"), null.alias("col"))
    c_rows = cols.select(qid, "tlc", "clc", F.col("tbl_c").alias("tbl"), F.col("col_c").alias("col"))
    return t_rows.unionByName(c_rows)


def mention_records(queries: DataFrame, mentions: DataFrame, catalog: DataFrame, qid: str = "query_id",
                    failed: str = "parse_failed", scope: Sequence[str] = SCOPE) -> DataFrame:
    """C7 over a batch: one record ``qid, parse_failed, schema_links`` for each of ``queries(qid, parse_failed)``.  A
    query that could not be parsed (a null counts as parsed) keeps its record with no links, whatever mentions
    came with it; so does one that mentions nothing in the catalog."""
    bad = F.coalesce(F.max(failed), F.lit(False)).alias(failed)
    records = queries.groupBy(qid).agg(bad)
    parsed = mentions.join(records.where(~F.col(failed)).select(qid), qid, "left_semi")
    links = resolve_mentions(parsed, catalog, qid, scope)
    return records.join(pack_links(links, [qid], records), qid).select(qid, failed, "schema_links")
