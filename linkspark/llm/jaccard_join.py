"""N-gram Jaccard join by skipping over set relations.

A document's set is its distinct word shingles; documents link when ``100 * intersection >= percent *
union``.  The join is exact and returns components, so links that only join what is joined already need
not be listed.

1. Equal sets become one set.  Prefixes follow one global order: shingles of a fixed part of the hash space
   (``REGION``/16) by document frequency, rare first, and the rest by hash.  A shingle of frequency 1 links
   nothing, so a set whose prefix holds only such shingles leaves at once.
2. Index lists hold (set, size, position).  Entries of a list are blocked by size and position; blocks that
   the size or position bound rules out are skipped whole.  In each block one set leads, and every other set
   is compared with its leaders only (a few rounds with other leaders): linear in the entries.
3. A set linked to a leader takes over the leader's answers.  Lists are then joined between homes (leaders
   with their linked sets) of different components, never between members; from the exact distance of two
   homes and of members to their homes the triangle inequality of the Jaccard distance settles the members'
   answers, and only unsettled member pairs that share a list are computed.

Sets of 64-bit shingle hashes are sorted arrays; only sets in some candidate pair are built a second time,
found through a bitmap of fixed size and an exact join.  No list, group or component meets in one task or
the driver: leaders come from partial aggregation, and joins on hot lists are split by the adaptive planner.

Defined cases: null texts, empty texts and texts without words have the empty set, which links with nothing
(the component is the row's own id); with fewer words than a shingle the whole sequence is the one shingle;
repeated rows and equal texts share a component; null ids are never the smallest; an empty table gives an
empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from linkspark.llm.common import materialise, neutral_names, read
from linkspark.llm.text_features import mix

WORDS, PERCENT = 4, 85
#: Sixteenths of the hash space whose shingles are counted; the prefix takes (100 - percent) % of a set.
REGION = {85: 4, 80: 5}
ROUNDS = 3
BITMAP_WORDS = 1 << 17  # longs in the bitmap of wanted sets (1 MB)
PARITY = 16  # longs of a set's parity bits
SHINGLE_BYTES = 1 << 19  # text whose sets are built at once

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_BASE, _CHAIN = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of all texts, in order, and the number of its text."""
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    origin = np.zeros(len(data), np.int64)
    origin[starts] = starts
    place = np.arange(len(data)) - np.maximum.accumulate(origin)
    place[space] = 0
    power = np.concatenate(([np.uint64(1)], np.cumprod(np.full(int(place.max()), _BASE))))
    each = np.where(space, np.uint64(0), _BYTE[data] * power[place])
    begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    return mix(np.add.reduceat(each, starts)), np.searchsorted(begin, starts, side="right") - 1


def shingle_sets(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """All texts' sets in one sorted array, and where each begins (one more than there are texts)."""
    w, owner = word_hashes(texts)
    n = np.bincount(owner, minlength=len(texts))
    k = max(len(w) - words + 1, 0)
    h = np.full(k, words, np.uint64)
    for j in range(words):
        h = mix(h * _CHAIN + w[j: j + k])
    inside = owner[:k] == owner[words - 1:] if k else np.empty(0, bool)
    h, whose = h[inside], owner[:k][inside]
    short = np.flatnonzero((n > 0) & (n < words))
    if len(short):  # the whole sequence; its length keeps it apart from shingles
        begin = np.concatenate(([0], np.cumsum(n)))
        whole = []
        for i in short:
            x = np.full(1, n[i], np.uint64)
            for v in w[begin[i]: begin[i + 1]]:
                x = mix(x * _CHAIN + v)
            whole.append(x[0])
        h, whose = np.concatenate([h, np.array(whole, np.uint64)]), np.concatenate([whose, short])
    order = np.lexsort((h, whose))
    h, whose = h[order], whose[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (whose[1:] != whose[:-1])
    return h[new], np.searchsorted(whose[new], np.arange(len(texts) + 1))


def least_overlap(n, percent: int):
    """What a set of ``n`` must share with any set it links with."""
    return -(-percent * n // 100)


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray, bytes | None]]:
    """Row number, set and 128-bit set digest (None if empty) of each row of a batch."""
    texts: list[bytes] = []
    size = 0
    for at, t in enumerate(batch.column("text"), 1):
        texts.append((t.as_py() or "").encode("utf-8", "surrogatepass"))
        size += len(texts[-1])
        if size >= SHINGLE_BYTES or at == len(batch):  # the arrays take some fifty times the text
            h, begin = shingle_sets(texts, words)
            for i, (a, b) in enumerate(zip(begin[:-1], begin[1:]), at - len(texts)):
                yield i, h[a:b], hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest() if b > a else None
            texts, size = [], 0


def digest_rows(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, n, sid``: size and digest of every row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(s), d) for _, s, d in _sets(batch, words)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()),
                                              pa.array([r[1] for r in rows], pa.binary())], ["doc_id", "n", "sid"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, sid binary")


def _region_sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``sid, n, region, extra``: a set's shingles in the counted region, and of the others the first that
    its prefix needs where the region has too few."""
    limit = np.uint64(REGION.get(percent, 6) << 60)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, s, d in _sets(batch, words):
                if d is not None:
                    cut = int(np.searchsorted(s, limit))
                    more = max(0, len(s) - least_overlap(len(s), percent) + 1 - cut)
                    out.append((d, len(s), s[:cut].view(np.int64), s[cut: cut + more].view(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.int64()),
                     pa.array([r[2] for r in out], pa.list_(pa.int64())), pa.array([r[3] for r in out], pa.list_(pa.int64()))],
                    ["sid", "n", "region", "extra"])

    return docs.select("text").mapInArrow(run, "sid binary, n long, region array<bigint>, extra array<bigint>")


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """``shingle, rid, n, pos`` of every prefix shingle that can link: the index lists."""
    each = sets.select("rid", F.explode("region").alias("shingle"))
    shared = each.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    lists = each.join(shared, "shingle").groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("common"))
    size = sets.select("rid", "n", F.size("region").alias("in_region"), "extra").join(lists, "rid", "left")
    common = F.coalesce(F.col("common"), F.expr("cast(array() as array<struct<df:bigint,shingle:bigint>>)"))
    single = (F.col("in_region") - F.size(common)).cast("long")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    size = size.select("rid", "n", "extra", "in_region", common.alias("common"), single.alias("single"), prefix.alias("prefix"))
    from_region = F.transform(
        F.slice("common", F.lit(1), F.greatest(F.lit(0), F.col("prefix") - F.col("single")).cast("int")),
        lambda x, i: F.struct(x["shingle"].alias("shingle"), (F.col("single") + i).alias("pos")))
    from_rest = F.transform("extra", lambda x, i: F.struct(x.alias("shingle"), (F.col("in_region") + i).cast("long").alias("pos")))
    return size.where((F.col("single") < F.col("prefix"))).select(
        "rid", "n", F.explode(F.concat(from_region, from_rest)).alias("e")).select("e.shingle", "rid", "n", "e.pos")


def _may_link(n_a: Column, pos_a: Column, n_b: Column, pos_b: Column, percent: int) -> Column:
    """Size bound, and position bound for the first common prefix shingle."""
    need = F.ceil((n_a + n_b) * percent / (100 + percent))
    return ((n_a * 100 >= n_b * percent) & (n_b * 100 >= n_a * percent) & (F.least(n_a - pos_a, n_b - pos_b) >= need))


def _leader_pairs(lists: DataFrame, percent: int, turn: int) -> DataFrame:
    """Every entry with the leaders of its own and the next smaller size block, where the bounds allow."""
    block = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)).cast("int")
    blocked = lists.withColumn("block", block)
    rank = F.xxhash64("rid", F.lit(turn)) if turn else F.col("rid")
    lead = blocked.groupBy("shingle", "block").agg(
        F.min(F.struct(rank.alias("r"), "rid", "n", "pos")).alias("lead")).select(
        "shingle", "block", F.col("lead.rid").alias("a"), F.col("lead.n").alias("n_a"), F.col("lead.pos").alias("pos_a"))
    asked = blocked.withColumn("block", F.explode(F.array(F.col("block"), F.col("block") - 1)))
    return (asked.join(lead, ["shingle", "block"]).where(
        (F.col("a") != F.col("rid")) & _may_link(F.col("n"), F.col("pos"), F.col("n_a"), F.col("pos_a"), percent))
        .select(F.least("a", "rid").alias("a"), F.greatest("a", "rid").alias("b")).distinct())


class _SetTable:
    """The sets of all rids asked for so far, built from the documents when first needed."""

    def __init__(self, docs: DataFrame, ids: DataFrame, words: int):
        self.docs, self.ids, self.words = docs, ids, words

    def build(self, wanted: DataFrame) -> DataFrame:
        """``rid, s`` (sorted little-endian hashes) of the rids in ``wanted``."""
        spark, words, bits = self.docs.sparkSession, self.words, BITMAP_WORDS * 64
        wanted = materialise(self.ids.join(wanted, "rid", "left_semi"), "jaccard-wanted")
        at = F.pmod(F.xxhash64("sid"), F.lit(bits))
        marks = wanted.groupBy(F.shiftright(at, 6).alias("w")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(sid), {bits}) & 63 as int))")).alias("m")).toArrow()
        bitmap = np.zeros(BITMAP_WORDS, np.uint64)
        bitmap[marks["w"].to_numpy()] = marks["m"].to_numpy().view(np.uint64)
        shared = spark.sparkContext.broadcast(bitmap)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(d, s) for _, s, d in _sets(batch, words) if d is not None]
                for i in range(0, len(found), 256):
                    part = found[i: i + 256]
                    yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in part], pa.binary()),
                                                      pa.array([s.astype("<u8").tobytes() for _, s in part], pa.binary())], ["sid", "s"])

        # the same hash as above decides, so the filter runs on Spark's side of a digest-only pass
        def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import xxhash

            for batch in run(batches):
                sid = batch.column("sid").to_pylist()
                at = [xxhash.xxh64_intdigest(x, 42) for x in sid]
                at = np.array([(v - (1 << 64) if v >> 63 else v) % bits for v in at])
                keep = (shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
                yield batch.filter(pa.array(keep.astype(bool)))

        return (self.docs.select("text").mapInArrow(likely, "sid binary, s binary").dropDuplicates(["sid"])
                .join(wanted, "sid").select("rid", "s"))


def _intersections(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, n_a, n_b, common`` of each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [np.frombuffer(s.as_buffer(), "<u8") for s in batch.column("s_a")]
            y = [np.frombuffer(s.as_buffer(), "<u8") for s in batch.column("s_b")]
            common = [len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(x, y)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *(pa.array(c, pa.int64()) for c in ([len(p) for p in x], [len(q) for q in y], common))],
                ["a", "b", "n_a", "n_b", "common"])

    one = lambda side: sets.select(F.col("rid").alias(side), F.col("s").alias(f"s_{side}"))
    return pairs.select("a", "b").join(one("b"), "b").join(one("a"), "a").mapInArrow(run, "a long, b long, n_a long, n_b long, common long")


def _parity_bits(sets: DataFrame) -> DataFrame:
    """``rid, size, p0 ...``: for each of ``64 * PARITY`` buckets, whether an odd number of shingles falls in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, size = np.zeros((len(batch), PARITY * 64), np.uint8), []
            for row, s in zip(bits, batch.column("s")):
                h = np.frombuffer(s.as_buffer(), "<u8")
                row[:] = np.bincount((mix(h) % np.uint64(PARITY * 64)).astype(np.int64), minlength=PARITY * 64) & 1
                size.append(len(h))
            words = np.packbits(bits, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(size, pa.int64()), *(pa.array(words[:, k]) for k in range(PARITY))],
                                             ["rid", "size", *(f"p{k}" for k in range(PARITY))])

    return sets.select("rid", "s").mapInArrow(run, "rid long, size long, " + ", ".join(f"p{k} long" for k in range(PARITY)))


def components(edges: DataFrame) -> DataFrame:
    """``rid, comp`` (the smallest rid of the component) of all ends of ``edges (a, b)``.  Every round each
    vertex joins its smallest neighbour, two steps at once, and edges are drawn anew between the joined."""
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    old = [materialise(edges.select("a", "b").where("a != b").distinct(), "jaccard-edges")]
    labels = None
    while True:
        step = both(old[-1]).groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("m"))
        step = materialise(step, "jaccard-step")
        jump = step.select(F.col("v").alias("m"), F.col("m").alias("mm"))
        step2 = materialise(step.join(jump, "m", "left").select("v", F.coalesce("mm", "m").alias("m")), "jaccard-step")
        to = lambda c: step2.select(F.col("v").alias(c), F.col("m").alias(f"{c}2"))
        if labels is None:
            labels = materialise(step2.select(F.col("v").alias("rid"), F.col("m").alias("comp")), "jaccard-labels")
        else:
            labels = materialise(labels.join(to("comp"), "comp", "left").select("rid", F.coalesce("comp2", "comp").alias("comp")), "jaccard-labels")
        left = materialise(old[-1].join(to("a"), "a").join(to("b"), "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
                           .where("a != b").distinct(), "jaccard-edges")
        old.append(left)
        if left.isEmpty():
            return labels


def linked_sets(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """``sid, rid`` of every distinct set, and ``rid, comp`` of every set that links with another."""
    found = materialise(_region_sets(docs, words, percent).groupBy("sid").agg(
        F.first("n").alias("n"), F.first("region").alias("region"), F.first("extra").alias("extra"))
        .withColumn("rid", F.monotonically_increasing_id()), "jaccard-sets")
    ids = found.select("sid", "rid")
    lists = materialise(_postings(found, percent), "jaccard-lists")
    alone = lists.groupBy("shingle").agg(F.count("*").alias("c")).where("c > 1").select("shingle")
    lists = materialise(lists.join(alone, "shingle", "left_semi"), "jaccard-lists")

    # leaders: a few rounds, each linear in the entries
    pairs = None
    for turn in range(ROUNDS):
        more = _leader_pairs(lists, percent, turn)
        pairs = more if pairs is None else pairs.unionByName(more).distinct()
    pairs = materialise(pairs, "jaccard-pairs")
    table = _SetTable(docs, ids, words)
    ends = lambda p: p.select(F.col("a").alias("rid")).unionByName(p.select(F.col("b").alias("rid"))).distinct()
    # a list's entries may all be asked for later on, so their sets are built once, now
    sets = materialise(table.build(lists.select("rid").distinct()), "jaccard-arrays")
    known = materialise(_intersections(pairs, sets), "jaccard-known")
    linked = F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * percent
    distance = 1 - F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common"))
    links = known.where(linked)
    comp = components(links)

    # homes: each linked set goes to its nearest leader with a smaller rid; the others are their own
    home = materialise(links.groupBy(F.col("b").alias("rid")).agg(F.min(F.struct(distance.alias("d"), F.col("a").alias("home"))).alias("h"))
                       .select("rid", "h.home", "h.d"), "jaccard-home")
    radius = home.groupBy(F.col("home").alias("h")).agg(F.max("d").alias("radius"))
    entries = lists.join(home, "rid", "left").join(comp, "rid", "left").select(
        "shingle", "rid", "n", "pos", F.coalesce("home", "rid").alias("home"), F.coalesce("comp", "rid").alias("comp"), F.coalesce("d", F.lit(0.0)).alias("d"))
    mixed = entries.groupBy("shingle").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y").select("shingle")
    entries = materialise(entries.join(mixed, "shingle", "left_semi"), "jaccard-entries")
    reach = 1 - percent / 100 + 1e-9
    parity = materialise(_parity_bits(sets), "jaccard-parity")
    bits = materialise(parity.join(radius, F.col("rid") == F.col("h"), "left").drop("h")
                       .withColumn("radius", F.coalesce("radius", F.lit(0.0))).withColumnRenamed("rid", "home"), "jaccard-bits")
    blocks = entries.groupBy("shingle", "home", "comp").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("pos")).alias("room")).join(bits, "home")
    side = lambda x: blocks.select("shingle", *(F.col(c).alias(f"{c}_{x}") for c in blocks.columns if c != "shingle"))
    need = F.ceil((F.col("low_a") + F.col("low_b")) * percent / (100 + percent))
    # the same names serve for pairs of homes and for pairs of members
    apart = sum((F.bit_count(F.col(f"p{k}_a").bitwiseXOR(F.col(f"p{k}_b"))) for k in range(PARITY)), F.lit(0))
    near = 2 * apart / (F.col("size_a") + F.col("size_b") + apart) <= F.lit(reach) + F.col("radius_a") + F.col("radius_b")
    home_pairs = (side("a").join(side("b"), "shingle").where(
        (F.col("comp_a") < F.col("comp_b")) & (F.col("high_a") * 100 >= F.col("low_b") * percent)
        & (F.col("high_b") * 100 >= F.col("low_a") * percent) & (F.least("room_a", "room_b") >= need) & near)
        .select(F.least("home_a", "home_b").alias("a"), F.greatest("home_a", "home_b").alias("b")).distinct())
    home_pairs = materialise(home_pairs, "jaccard-home-pairs")
    if home_pairs.isEmpty():
        return ids, comp
    seen = known.select("a", "b", "n_a", "n_b", "common")
    old = home_pairs.join(seen, ["a", "b"])
    new = _intersections(home_pairs.join(seen, ["a", "b"], "left_anti"), sets)
    between = materialise(old.select("a", "b", "n_a", "n_b", "common").unionByName(new), "jaccard-between")
    links = links.select("a", "b").unionByName(between.where(linked).select("a", "b"))
    comp = components(links)

    # members: answers that the triangle inequality leaves open, between sets that share a list
    r = lambda c: radius.select(F.col("h").alias(c), F.col("radius").alias(f"r_{c}"))
    now = comp.select("rid", F.col("comp").alias("now"))
    at = lambda c: now.select(F.col("rid").alias(c), F.col("now").alias(f"now_{c}"))
    open_ = (between.where(~linked).withColumn("d_ab", distance).join(r("a"), "a", "left").join(r("b"), "b", "left")
             .where(F.col("d_ab") - F.coalesce("r_a", F.lit(0.0)) - F.coalesce("r_b", F.lit(0.0)) <= reach)
             .where(F.col("r_a").isNotNull() | F.col("r_b").isNotNull())
             .join(at("a"), "a", "left").join(at("b"), "b", "left")
             .where(F.coalesce("now_a", "a") != F.coalesce("now_b", "b")).select("a", "b", "d_ab"))
    open_ = materialise(open_, "jaccard-open")
    e = entries.drop("comp").join(now, "rid", "left").withColumn("now", F.coalesce("now", "rid"))
    e = e.join(open_.select(F.col("a").alias("home")).union(open_.select("b")).distinct(), "home", "left_semi").join(parity, "rid")
    x = lambda s: e.select("shingle", *(F.col(c).alias(f"{c}_{s}") for c in e.columns if c != "shingle"))
    member_pairs = (x("a").join(x("b"), "shingle")
        .where((F.col("now_a") != F.col("now_b")) & (F.col("home_a") < F.col("home_b"))
               & (2 * apart / (F.col("size_a") + F.col("size_b") + apart) <= reach)
               & _may_link(F.col("n_a"), F.col("pos_a"), F.col("n_b"), F.col("pos_b"), percent))
        .join(open_, (F.col("home_a") == F.col("a")) & (F.col("home_b") == F.col("b")))
        .where(F.col("d_ab") - F.col("d_a") - F.col("d_b") <= reach)
        .select(F.least("rid_a", "rid_b").alias("a"), F.greatest("rid_a", "rid_b").alias("b")).distinct())
    member_pairs = materialise(member_pairs.join(seen, ["a", "b"], "left_anti"), "jaccard-member-pairs")
    if member_pairs.isEmpty():
        return ids, comp
    last = _intersections(member_pairs, sets).where(linked).select("a", "b")
    return ids, components(links.unionByName(last))


def join_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n, sid, component_id`` of every row of ``docs``."""
    rows = materialise(digest_rows(docs, words), "jaccard-rows")
    return _row_components(rows, *linked_sets(docs, words, percent))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: one of the smallest id, null ids last, of equal rows any.
    Rows without words link with nothing and all stay."""
    rows = materialise(digest_rows(docs, words), "jaccard-rows")
    ids, comp = linked_sets(docs, words, percent)
    group = ids.join(comp, "rid", "left").select("sid", F.coalesce("comp", "rid").alias("group"))
    each = rows.where("sid is not null").groupBy("sid", "doc_id").agg(F.count("*").alias("copies"))
    best = (each.join(group, "sid").groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "sid", "copies")).alias("k"))
        .select(F.col("k.doc_id").alias("_id"), F.col("k.sid").alias("_keep"), F.col("k.copies").alias("_copies")))
    plain = neutral_names(docs, ("doc_id", "text"))
    columns = plain.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid = pa.array([d for _, _, d in _sets(batch, words)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, sid], schema=pa.schema([*batch.schema, ("_sid", pa.binary())]))

    marked = plain.mapInArrow(run, StructType([*plain.schema.fields]).add("_sid", BinaryType()))
    kept = marked.join(best, (F.col("_sid") == F.col("_keep")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left").where(
        F.col("_copies").isNotNull() | F.col("_sid").isNull())
    single = kept.where(F.coalesce("_copies", F.lit(1)) == 1)
    return single.select(columns).unionByName(
        kept.where("_copies > 1").dropDuplicates(["_sid"]).select(columns)).toDF(*docs.columns)


def _row_components(rows: DataFrame, ids: DataFrame, comp: DataFrame) -> DataFrame:
    first = rows.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("first_id"))
    sets = first.join(ids.join(comp, "rid"), "sid", "left")
    least = sets.where("comp is not null").groupBy("comp").agg(F.min("first_id").alias("component_id"))
    of_set = sets.join(least, "comp", "left").select("sid", F.coalesce("component_id", "first_id").alias("component_id"))
    with_words = rows.where("sid is not null").join(of_set, "sid").select("doc_id", "n", "sid", "component_id")
    return with_words.unionByName(rows.where("sid is null").withColumn("component_id", F.col("doc_id")))


def op5_jaccard_set_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return join_components(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
