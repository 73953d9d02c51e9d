"""Rank catalog tables against questions.

BM25 is computed as an inverted-index join: document tokens are exploded once,
filtered to the vocabulary the questions actually use (size-checked broadcast
semi-join, before any shuffle), counted per (document, term) and joined to the
question terms on ``(corpus, term)``.  Only (question, document, term) triples
that match are ever produced; no question x document grid is built.

Embedding similarity runs as a blocked NumPy kernel: the vectors and the questions
of each corpus are hashed into blocks sized from the corpus' own row counts, and every
(corpus, document block, question block) group returns only its local top-k per
question.  A final window keeps the global top-k.  A corpus with most of the
documents, or most of the questions, therefore spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import tokenize
from ..plans.joins import broadcast_if_small, estimated_size_bytes, spread, written

K1 = 1.5   # fixed BM25 constants of the reference ranking
B = 0.75
RRF_K = 60
BROADCAST_POSTINGS = 500_000  # an index of so many postings goes to all tasks
MATCHES = 500_000  # matches that a task adds up at once; a question's own stay together
INDEX_BYTES = 8 * 1024 * 1024  # documents of so few bytes are indexed whole
TIE_DIGITS = 9  # scores are rounded before ranking so 1-ulp summation noise cannot flip ties


def doc_terms(docs: DataFrame, corpus: str, doc: str, text: str, vocabulary: DataFrame | None = None):
    """Tokenise documents once.

    Returns ``(stats, tf)``: ``stats(corpus, n_docs, avgdl)`` over *all* documents and
    ``tf(corpus, doc, term, f, dl)`` restricted to ``vocabulary(corpus, term)`` when given.  With a vocabulary the counts
    are written, so that both sides, however often they are used, take one pass over the texts.
    """
    toks = spread(docs.select(F.col(corpus).alias("corpus"), F.col(doc).alias("doc"), F.col(text).alias("text")))
    toks = toks.select("corpus", "doc", tokenize("text").alias("toks")).withColumn("len", F.size("toks"))
    if vocabulary is not None:
        return _counted_terms(toks, vocabulary)
    stats = toks.groupBy("corpus").agg(F.count(F.lit(1)).alias("n_docs"),
                                       F.avg("len").alias("avgdl"))
    terms = toks.select("corpus", "doc", F.greatest(F.lit(1), F.col("len")).alias("dl"),
                        F.explode_outer("toks").alias("term")).where(F.col("term").isNotNull())
    tf = terms.groupBy("corpus", "doc", "term").agg(F.count(F.lit(1)).alias("f"), F.first("dl").alias("dl"))
    return stats, tf


def _counted_terms(toks: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """:func:`doc_terms` of ``toks(corpus, doc, toks, len)`` in one pass: a row for the document itself (no term) and one
    for each of its different terms in the vocabulary."""
    known = broadcast_if_small(vocabulary.select("corpus", "term").distinct())
    itself = F.array(F.lit(None).cast("string"))
    words = toks.select("corpus", "doc", "len", F.explode(F.concat(itself, F.coalesce("toks", F.array().cast("array<string>")))).alias("term"))
    found = words.join(known.withColumn("known", F.lit(True)), ["corpus", "term"], "left").where("known or term is null")
    counted = written(found.groupBy("corpus", "doc", "len", "term").agg(F.count(F.lit(1)).alias("n")), "terms")
    rows = counted.where("term is null")
    sized = F.sum(F.when(F.col("len").isNotNull(), F.col("n")))
    stats = rows.groupBy("corpus").agg(F.sum("n").alias("n_docs"), (F.sum(F.col("len").cast("long") * F.col("n")) / sized).alias("avgdl"))
    tf = (counted.where("term is not null").groupBy("corpus", "doc", "term")
          .agg(F.sum("n").alias("f"), F.first(F.greatest(F.lit(1), F.col("len"))).alias("dl")))
    return stats, tf


def question_terms(questions: DataFrame, qid: str, corpus: str, text: str) -> DataFrame:
    """``(qid, corpus, term, qf)``: repeated question words count once per occurrence."""
    q = questions.select(F.col(qid).alias("qid"), F.col(corpus).alias("corpus"),
                         F.explode(tokenize(text)).alias("term"))
    return q.groupBy("qid", "corpus", "term").agg(F.count(F.lit(1)).alias("qf"))


def _postings(index: DataFrame) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
    """``index(corpus, term, d, impact)`` as arrays: the number of each (corpus, term), where its postings start, and the
    document and impact of each posting."""
    t = index.select(F.col("corpus").cast("string").alias("corpus"), "term", "d", "impact").toArrow().sort_by([("corpus", "ascending"), ("term", "ascending"), ("d", "ascending")])
    names = list(zip(t["corpus"].to_pylist(), t["term"].to_pylist()))
    first = [i for i, name in enumerate(names) if i == 0 or name != names[i - 1]]
    return {names[i]: k for k, i in enumerate(first)}, np.array([*first, len(names)], np.int64), t["d"].to_numpy(), t["impact"].to_numpy()


def _add_up(question: np.ndarray, d: np.ndarray, share: np.ndarray, questions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different documents ``d`` of each question, in order, and the sums of their shares; before them, where each of the
    ``questions`` starts."""
    if not len(d):
        return np.zeros(questions + 1, np.int64), d, share
    docs = int(d.max()) + 1
    key = question * docs + d
    order = np.argsort(key, kind="stable")  # runs of ascending documents are merged
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    starts = np.searchsorted(key[first], np.arange(questions + 1) * docs)
    return starts, d[order[first]], np.add.reduceat(share[order], first)


def _add_up_batches(index: Broadcast):
    """An Arrow function of ``(corpus, terms)``: the documents that a question matches, by number, and their scores.
    ``index`` holds the :func:`_postings`."""
    @F.arrow_udf("struct<d:array<int>,score:array<double>>")
    def score(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        numbers, starts, doc, impact = index.value
        for corpus, terms in batches:
            words, where = terms.flatten().dictionary_encode(), corpus.dictionary_encode()
            question = np.repeat(np.arange(len(terms)), terms.value_lengths().fill_null(0).to_numpy())
            of = where.indices.fill_null(len(where.dictionary)).to_numpy()[question].astype(np.int64)
            # each different (corpus, word) of the batch is looked up once
            pairs, which = np.unique(of * max(len(words.dictionary), 1) + words.indices.to_numpy(), return_inverse=True)
            corpora, said = [*where.dictionary.to_pylist(), None], words.dictionary.to_pylist()
            found = np.array([numbers.get((corpora[p // len(said)], said[p % len(said)]), -1) for p in pairs.tolist()], np.int64)[which]
            # a word that a question repeats is one, with its count
            terms_of, qf = np.unique((question * len(starts) + found)[found >= 0], return_counts=True)
            question, found = terms_of // len(starts), terms_of % len(starts)
            n = starts[found + 1] - starts[found]
            upto = np.concatenate([[0], np.cumsum(np.bincount(question, n, len(terms)).astype(np.int64))])
            begin = 0
            while begin < len(terms):
                end = max(begin + 1, int(np.searchsorted(upto, upto[begin] + MATCHES, "right")) - 1)
                here = slice(*np.searchsorted(question, [begin, end]))
                many, total = n[here], int(n[here].sum())
                at = np.repeat(starts[found[here]] - (np.cumsum(many) - many), many) + np.arange(total)
                offsets, d, scores = _add_up(np.repeat(question[here] - begin, many), doc[at], impact[at] * np.repeat(qf[here], many), end - begin)
                offsets = pa.array(offsets, pa.int32())
                yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(d, pa.int32())),
                                                  pa.ListArray.from_arrays(offsets, pa.array(scores, pa.float64()))], ["d", "score"])
                begin = end

    return score


def bm25(questions: DataFrame, docs: DataFrame, qid: str = "question_id", corpus: str = "db_id",
         q_text: str = "question", doc: str = "table_idx", d_text: str = "text",
         k1: float = K1, b: float = B, as_arrays: bool = False) -> DataFrame:
    """``(qid, corpus, doc, score)`` for every (question, document) with score > 0.

    ``idf = ln(1 + (N - df + .5) / (df + .5))`` per corpus, ``dl = max(1, len)``,
    ``avgdl`` over all documents of the corpus.  Documents of a corpus no question
    targets never reach a shuffle.

    Where the documents are few, or the questions the larger side, the index is written once, of all terms, and goes to all tasks if it is
    small: questions that come partitioned by ``qid`` are then scored where they are, and no match is exchanged.  With ``as_arrays`` a
    task then adds up the matches of its questions in NumPy, for questions with many matches each; Spark does not know afterwards
    that the scores are partitioned as the questions are.
    """
    qt = question_terms(questions, qid, corpus, q_text)
    sizes = estimated_size_bytes(questions), estimated_size_bytes(docs)
    many = None not in sizes and (sizes[1] <= INDEX_BYTES or sizes[0] > sizes[1])
    stats, tf = doc_terms(docs, corpus, doc, d_text, None if many else qt.select("corpus", "term").distinct())
    df = tf.groupBy("corpus", "term").agg(F.count(F.lit(1)).alias("df"))
    st = broadcast_if_small(stats)
    idf = (df.join(st, "corpus")
           .select("corpus", "term", "avgdl",
                   F.log(1.0 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")))
    index = tf.join(idf, ["corpus", "term"])
    few = False
    if many:
        index = written(index, "index")
        few = index.count() <= BROADCAST_POSTINGS
    w = F.col("f") * (k1 + 1) / (F.col("f") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
    if few and as_arrays:
        scored = _scored_as_arrays(questions, index.select("corpus", "doc", "term", (F.col("idf") * w).alias("impact")), qid, corpus, q_text)
    else:
        hits = qt.join(F.broadcast(index) if few else index, ["corpus", "term"])
        scored = hits.groupBy("qid", "corpus", "doc").agg(F.sum(F.col("qf") * F.col("idf") * w).alias("score"))
    return scored.select(F.col("qid").alias(qid), F.col("corpus").alias(corpus),
                         F.col("doc").alias(doc), "score")


def _scored_as_arrays(questions: DataFrame, index: DataFrame, qid: str, corpus: str, text: str) -> DataFrame:
    """``qid, corpus, doc, score`` of ``questions`` by an ``index(corpus, doc, term, impact)`` that goes to all tasks."""
    docs = written(index.select("corpus", "doc").distinct().coalesce(1).withColumn("d", F.monotonically_increasing_id().cast("int")), "docs")
    same = (F.col("i.corpus") == F.col("n.corpus")) & F.col("i.doc").eqNullSafe(F.col("n.doc"))
    numbered = index.alias("i").join(F.broadcast(docs).alias("n"), same).select("i.corpus", "term", "d", "impact")
    score = _add_up_batches(questions.sparkSession.sparkContext.broadcast(_postings(numbered)))
    # a question that comes in several rows is one
    q = questions.select(F.col(qid).alias("qid"), F.col(corpus).alias("corpus"), tokenize(text).alias("terms"))
    q = q.groupBy("qid", "corpus").agg(F.flatten(F.collect_list("terms")).alias("terms"))
    found = q.select("qid", "corpus", score(F.col("corpus").cast("string"), "terms").alias("found"))
    each = found.select("qid", "corpus", F.col("found.score").alias("scores"), F.posexplode_outer("found.d").alias("i", "d"))
    return (each.join(F.broadcast(docs.select("d", "doc")), "d")
            .select("qid", "corpus", "doc", F.get("scores", F.col("i")).alias("score")))


def top_k_with_fill(scores: DataFrame, questions: DataFrame, docs: DataFrame, k: int,
                    qid: str = "question_id", corpus: str = "db_id", doc: str = "table_idx") -> DataFrame:
    """Top-k documents per question by score desc, ties by document order, and
    zero-score documents filling the remaining slots in document order (T11).

    Exact without a question x document grid: if fewer than k documents score > 0,
    the fill comes from the first k documents of the corpus (they always contain
    enough unmatched ones), so only those k are joined to each question.
    """
    first_k = (docs.select(F.col(corpus).alias(corpus), F.col(doc).alias(doc))
               .withColumn("_r", F.row_number().over(Window.partitionBy(corpus).orderBy(doc)))
               .where(F.col("_r") <= k).drop("_r"))
    fill = (questions.select(qid, corpus).join(broadcast_if_small(first_k), corpus)
            .withColumn("score", F.lit(0.0)))
    cand = (scores.select(qid, corpus, doc, "score").unionByName(fill)
            .groupBy(qid, corpus, doc).agg(F.max("score").alias("score")))
    w = Window.partitionBy(qid).orderBy(F.desc(F.round("score", TIE_DIGITS)), F.asc(doc))
    return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def best_of(scores: DataFrame, k: int, qid: str = "question_id", doc: str = "table_idx") -> DataFrame:
    """The ``k`` best scored documents of each question, ties by document order, with ``rank``."""
    w = Window.partitionBy(qid).orderBy(F.desc(F.round("score", TIE_DIGITS)), F.asc(doc))
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# ---------------------------------------------------------------- embeddings

_TOPK_SCHEMA = T.StructType([
    T.StructField("qid", T.LongType()), T.StructField("doc", T.LongType()),
    T.StructField("score", T.DoubleType()),
])


def _chunks(n: int, size: int = 256):
    return (slice(at, at + size) for at in range(0, n, size))


def _block_topk(k: int):
    def kernel(qdf: pd.DataFrame, ddf: pd.DataFrame) -> pd.DataFrame:
        out_q, out_d, out_s = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if not qdf.empty and not ddf.empty:
            qm = np.stack(qdf["vec"].to_numpy()).astype(np.float64)
            dm = np.stack(ddf["vec"].to_numpy()).astype(np.float64)
            qids, ids = qdf["qid"].to_numpy(), ddf["doc"].to_numpy()
            kk = min(k, len(ids))
            for part in _chunks(len(qm)):
                sims = qm[part] @ dm.T
                rounded = np.round(sims, TIE_DIGITS)
                rounded[np.isnan(rounded)] = -np.inf
                least = np.partition(rounded, len(ids) - kk, axis=1)[:, len(ids) - kk]
                for q, line, score, kth in zip(qids[part], rounded, sims, least):
                    c = np.flatnonzero(line >= kth)  # ties with the last place included, settled by id
                    c = c[np.lexsort((ids[c], -line[c]))[:kk]]
                    out_q.append(np.full(kk, q, np.int64)); out_d.append(ids[c]); out_s.append(score[c])
        return pd.DataFrame({"qid": np.concatenate(out_q).astype("int64"),
                             "doc": np.concatenate(out_d).astype("int64"),
                             "score": np.concatenate(out_s)})
    return kernel


def _grid(queries: DataFrame, docs: DataFrame, n_queries: DataFrame, query_rows: int,
          block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``block`` and ``qblock``: within a corpus every query meets every document in one
    (block of documents, block of queries) group, and no group grows with the corpus or with its questions.

    ``queries(corpus, qid, ...)``, ``docs(corpus, doc, ...)``, ``n_queries(corpus, qid)`` one row a query.  Blocks
    are sized from one count a corpus on either side; a corpus without documents or without queries drops out.
    """
    blocks = lambda n, most: F.greatest(F.lit(1), F.ceil(n / most)).cast("int")
    sizes = (docs.groupBy("corpus").agg(blocks(F.count(F.lit(1)), block_rows).alias("nb"))
             .join(n_queries.groupBy("corpus").agg(blocks(F.count(F.lit(1)), query_rows).alias("nq")), "corpus"))
    sizes = broadcast_if_small(sizes)
    own = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = queries.join(sizes, "corpus").withColumn("qblock", own("qid", "nq")).withColumn("block", every("nb"))
    right = docs.join(sizes, "corpus").withColumn("block", own("doc", "nb")).withColumn("qblock", every("nq"))
    return left.drop("nb", "nq"), right.drop("nb", "nq")


def cosine_top_k(queries: DataFrame, vectors: DataFrame, k: int, qid: str = "qid",
                 doc: str = "vec_id", corpus: str = "db_id", vec: str = "embedding",
                 block_rows: int = 4096, query_rows: int = 4096) -> DataFrame:
    """D3: top-k vectors per query by cosine (dot of unit vectors), ties by id.

    ``queries(qid, corpus, vec)`` and ``vectors(doc, corpus, vec)``.  Documents and queries of a
    corpus are both cut into blocks (``_grid``); every pair of blocks is a cogroup task of its own
    that multiplies 256 queries at a time and returns only its local top-k.
    """
    v = vectors.select(F.col(doc).cast("long").alias("doc"), F.col(corpus).alias("corpus"),
                       F.col(vec).alias("vec"))
    q = queries.select(F.col(qid).cast("long").alias("qid"), F.col(corpus).alias("corpus"),
                       F.col(vec).alias("vec"))
    qb, vb = _grid(q, v, q, query_rows, block_rows)
    keys = ("corpus", "block", "qblock")
    local = qb.groupBy(*keys).cogroup(vb.groupBy(*keys)).applyInPandas(_block_topk(k), _TOPK_SCHEMA)
    w = Window.partitionBy("qid").orderBy(F.desc(F.round("score", TIE_DIGITS)), F.asc("doc"))
    ranked = local.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select(F.col("qid").alias(qid), F.col("doc").alias(doc), "score", "rank")


def cosine_native(a, b):
    """Dot product of two ``ARRAY<FLOAT>`` columns as DOUBLE (small pair sets)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


# ---------------------------------------------------------------- evaluation helpers

def recall_at_k(ranked: DataFrame, gold: DataFrame, ks: Sequence[int], qid: str = "question_id",
                doc: str = "table_idx") -> DataFrame:
    """Share of gold documents that appear within the top-k, for every k in ``ks``
    (``ranked`` carries ``rank`` and must hold at least max(ks) per question)."""
    # both sides in one aggregation, in place where they are partitioned by question alike; null keys match nothing
    places = ranked.where(F.col(qid).isNotNull() & F.col(doc).isNotNull()).select(qid, doc, "rank")
    j = (gold.select(qid, doc, F.lit(1).cast("long").alias("_g")).unionByName(places, allowMissingColumns=True)
         .groupBy(qid, doc).agg(F.sum("_g").alias("_g"), F.min("rank").alias("rank")).where("_g is not null"))
    return j.agg(*[(F.sum(F.when(F.col("rank") <= k, F.col("_g")).otherwise(0)) / F.sum("_g")).alias(f"recall_at_{k}") for k in ks],
                 F.coalesce(F.sum("_g"), F.lit(0)).alias("n_gold"))


def recall_curve(ranked: DataFrame, gold: DataFrame, most: int, by: Sequence[str] = ("retriever",), qid: str = "question_id",
                 doc: str = "table_idx") -> DataFrame:
    """For each retriever of ``ranked (by, qid, doc, rank)`` and every k up to ``most``, the share of gold documents
    among the k best.  One count per rank, added up over at most ``most`` rows a retriever."""
    by = list(by)
    ranked = written(ranked.select(*by, qid, doc, "rank"), "ranked")  # used twice, but ranked once
    total = gold.select(qid, doc).distinct().agg(F.count(F.lit(1)).alias("n_gold"))
    hits = (gold.select(qid, doc).distinct().join(ranked.where(F.col("rank") <= most), [qid, doc])
            .groupBy(*by, "rank").agg(F.count(F.lit(1)).alias("hits")))
    every = ranked.select(*by).distinct().withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(most))))
    upto = F.sum(F.coalesce("hits", F.lit(0))).over(Window.partitionBy(*by).orderBy("k"))
    at = every.join(hits.withColumnRenamed("rank", "k"), [*by, "k"], "left").withColumn("found", upto)
    return at.withColumn("n_gold", total.scalar()).select(*by, F.col("k").cast("long").alias("k"), "found", "n_gold", (F.col("found") / F.col("n_gold")).alias("recall"))


def force_include(kept: DataFrame, gold: DataFrame, catalog_tables: DataFrame,
                  keys: Sequence[str] = ("question_id",), tbl: str = "tbl",
                  scope: Sequence[str] = ("db_id",)) -> DataFrame:
    """Add every gold table that exists in the question's own database to the kept set (distinct)."""
    keys, scope = list(keys), list(scope)
    g = gold.select(*dict.fromkeys([*keys, *scope]), F.lower(tbl).alias("tlc"))
    valid = g.join(broadcast_if_small(catalog_tables.select(*scope, "tlc")), [*scope, "tlc"], "left_semi")
    return kept.select(*keys, "tlc").unionByName(valid.select(*keys, "tlc")).distinct()


def voter_retrievers(specs: DataFrame, default: str, spec: str = "spec") -> DataFrame:
    """Voter lists like ``path[:retriever], ...`` as rows ``(spec, voter, path, retriever)``, voters
    counted from 1 over the entries that are not blank; the last colon parts the retriever off."""
    entries = F.filter(F.transform(F.split(spec, ","), lambda e: F.trim(e)), lambda e: e != "")
    e = specs.select(F.col(spec).alias("spec"), F.posexplode(entries).alias("pos", "entry"))
    named = F.contains("entry", F.lit(":"))
    retriever = F.substring_index("entry", ":", -1)
    path = F.substring("entry", F.lit(1), F.length("entry") - F.length(retriever) - 1)
    return e.select("spec", (F.col("pos") + 1).alias("voter"),
                    F.trim(F.when(named, path).otherwise(F.col("entry"))).alias("path"),
                    F.when(named, F.trim(retriever)).otherwise(F.lit(default)).alias("retriever"))


def voter_contexts(voters: DataFrame, rankings: DataFrame, k: int, qid: str = "question_id",
                   doc: str = "table_idx") -> DataFrame:
    """The top-k tables each voter sees, from ``rankings(retriever, qid, doc, rank)``.  Each retriever
    ranks once, whatever the number of its voters; a voter whose retriever has no ranking gets no rows."""
    kept = rankings.where(F.col("rank") <= k)
    return (kept.join(voters.select("voter", "path", "retriever"), "retriever")
            .select(qid, "voter", "path", "retriever", doc, "rank"))


# ---------------------------------------------------------------- reciprocal rank fusion

_COUNT_SCHEMA = T.StructType([
    T.StructField("qid", T.LongType()), T.StructField("doc", T.LongType()),
    T.StructField("n_before", T.LongType()), T.StructField("n_beat", T.LongType()),
])


def _count_kernel(cdf: pd.DataFrame, ddf: pd.DataFrame) -> pd.DataFrame:
    """Per candidate (query, doc): documents of this block ordered before the doc, and
    vector documents whose similarity beats the doc's (ties broken by id)."""
    if cdf.empty:
        return pd.DataFrame({c.name: pd.Series(dtype="int64") for c in _COUNT_SCHEMA.fields})
    d = cdf["doc"].to_numpy()
    before, beat = np.searchsorted(np.sort(ddf["doc"].to_numpy()), d), np.zeros(len(cdf), np.int64)
    with_vec = ddf[ddf["vec"].notna()]
    if len(with_vec):
        ids, dm = with_vec["doc"].to_numpy(), np.stack(with_vec["vec"].to_numpy()).astype(np.float64)
        cos = np.round(cdf["cos"].to_numpy(dtype=np.float64, na_value=np.nan), TIE_DIGITS)
        for at in cdf.groupby("qid", sort=False).indices.values():
            at = at[~np.isnan(cos[at])]
            if len(at):
                sims = np.round(dm @ np.asarray(cdf["qvec"].iloc[at[0]], dtype=np.float64), TIE_DIGITS)
                for part in _chunks(len(at)):
                    c, i = cos[at[part], None], d[at[part], None]
                    beat[at[part]] = ((sims > c) | ((sims == c) & (ids < i))).sum(axis=1)
    return pd.DataFrame({"qid": cdf["qid"].to_numpy(), "doc": d, "n_before": before, "n_beat": beat}).astype("int64")


def rrf_top_k(scores: DataFrame, questions: DataFrame, docs: DataFrame, doc_vecs: DataFrame, k: int,
              qid: str = "question_id", corpus: str = "db_id", doc: str = "table_idx",
              block_rows: int = 4096, query_rows: int = 256) -> DataFrame:
    """Top-k by ``1/(60 + r_bm25) + 1/(60 + r_emb)``; ranks start at 0, ties by document
    order, a document without a vector takes rank = number of vectors in its corpus.

    Exact without a question x document grid.  A document outside the top-M of both
    rankings (M = 59 + 2k) scores at most 2/(60+M) < 1/(59+k), below each of the k best
    BM25 documents, so candidates are the union of both top-M lists.  Their exact
    ranks come from (a) a window over the question's matched documents, (b) for
    zero-score documents, arithmetic on document order, and (c) a blocked kernel that
    counts, per candidate, the documents ordered before it and the vectors beating it.

    ``questions(qid, corpus, qvec)``, ``docs(corpus, doc)``, ``doc_vecs(doc, vec)``,
    ``scores(qid, corpus, doc, score)`` with score > 0.
    """
    m = 59 + 2 * k
    q = questions.select(F.col(qid).cast("long").alias("qid"), F.col(corpus).alias("corpus"), F.col("qvec"))
    d = docs.select(F.col(corpus).alias("corpus"), F.col(doc).cast("long").alias("doc"))
    v = doc_vecs.select(F.col(doc).cast("long").alias("doc"), F.col("vec"))
    dv = d.join(v, "doc", "left")
    pos = scores.select(F.col(qid).cast("long").alias("qid"), F.col(doc).cast("long").alias("doc"), "score")
    wb = Window.partitionBy("qid").orderBy(F.desc(F.round("score", TIE_DIGITS)), F.asc("doc"))
    # ranked once, and so are the candidates below: each is used several times
    pos = written(pos.withColumn("rb_pos", F.row_number().over(wb) - 1), "ranks")
    n_pos = pos.groupBy("qid").agg(F.count(F.lit(1)).alias("n_pos"))
    # candidates: BM25 top-M (positives, then zero-score fill from the first M docs) and embedding top-M
    first_m = (d.withColumn("_r", F.row_number().over(Window.partitionBy("corpus").orderBy("doc")))
               .where(F.col("_r") <= m).drop("_r"))
    c_bm = pos.where(F.col("rb_pos") < m).select("qid", "doc")
    c_fill = q.join(broadcast_if_small(first_m), "corpus").select("qid", "doc")
    qv = q.where(F.col("qvec").isNotNull()).select("qid", "corpus", F.col("qvec").alias("embedding"))
    vv = dv.where(F.col("vec").isNotNull()).select("doc", "corpus", F.col("vec").alias("embedding"))
    emb = cosine_top_k(qv, vv, m, doc="doc", corpus="corpus", block_rows=block_rows).select("qid", "doc")
    cand = c_bm.unionByName(c_fill).unionByName(emb).distinct()
    cand = (cand.join(q, "qid").join(dv, ["corpus", "doc"])
            .withColumn("cos", F.when(F.col("vec").isNotNull() & F.col("qvec").isNotNull(),
                                      cosine_native(F.col("qvec"), F.col("vec"))))
            .drop("vec"))
    cand = written(cand, "candidates")
    # (c) counts over every document of the corpus, block by block
    cb, dvb = _grid(cand.select("corpus", "qid", "doc", "qvec", "cos"), dv.select("corpus", "doc", "vec"),
                    q.select("corpus", "qid"), query_rows, block_rows)
    keys = ("corpus", "block", "qblock")
    counts = (cb.groupBy(*keys).cogroup(dvb.groupBy(*keys)).applyInPandas(_count_kernel, _COUNT_SCHEMA)
              .groupBy("qid", "doc").agg(F.sum("n_before").alias("n_before"), F.sum("n_beat").alias("n_beat")))
    n_vec = dv.groupBy("corpus").agg(F.count("vec").alias("n_vec"))
    # (a)+(b) positives before each candidate, by document order (window over the question's own rows)
    marks = (pos.select("qid", "doc", F.lit(1).alias("is_pos"))
             .unionByName(cand.select("qid", "doc", F.lit(0).alias("is_pos"))))
    wo = Window.partitionBy("qid").orderBy("doc", F.desc("is_pos")).rowsBetween(Window.unboundedPreceding, -1)
    before = (marks.withColumn("pos_before", F.coalesce(F.sum("is_pos").over(wo), F.lit(0)))
              .where(F.col("is_pos") == 0).select("qid", "doc", "pos_before"))
    r = (cand.join(counts, ["qid", "doc"]).join(before, ["qid", "doc"])
         .join(pos.select("qid", "doc", "rb_pos"), ["qid", "doc"], "left")
         .join(n_pos, "qid", "left").join(broadcast_if_small(n_vec), "corpus"))
    rb = F.coalesce(F.col("rb_pos"), F.coalesce(F.col("n_pos"), F.lit(0)) + F.col("n_before") - F.col("pos_before"))
    re = F.when(F.col("cos").isNull(), F.col("n_vec")).otherwise(F.col("n_beat"))
    fused = 1.0 / (RRF_K + rb) + 1.0 / (RRF_K + re)
    r = r.select("qid", "doc", rb.alias("rank_bm25"), re.alias("rank_embed"), fused.alias("fused"))
    w = Window.partitionBy("qid").orderBy(F.desc(F.round("fused", 12)), F.asc("doc"))
    top = r.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.select(F.col("qid").alias(qid), F.col("doc").alias(doc), "rank_bm25", "rank_embed", "fused", "rank")
