"""Best-fit packing of tokenised documents into fixed-length sequences.

Bounded-space online best-fit: a task keeps at most ``OPEN`` bins, found through a bitset with one bit for
each amount of free space; a piece goes to the fullest bin that takes it, and when too many are open the
fullest closes.  Tokenising and packing happen in one pass over the input's own partitions, so token ids
cross no exchange.  What the bins still open at a task's end hold (at most ``OPEN`` bins a task) is dealt
out anew to a few tasks, longest pieces first, and packed the same way; the number of those tasks grows
with the number of such pieces.

A document's ids are its tokens and then the separator 0; a vocabulary's added tokens that stand in a text
(``<|endoftext|>``) are one id each, as the tokenizer gives them.  Only documents longer than a sequence are cut,
into full sequences and a rest.

Defined cases: null and empty texts are the separator alone; ids may be null or repeated (each row is a
document); an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkspark.llm.common import materialise, read

LENGTH, OPEN, SEPARATOR = 2048, 256, 0
#: Pieces of unfinished bins that one task packs, and the bins it keeps open.
REST_PIECES, REST_OPEN = 50_000, 4096
#: Words whose ids a worker remembers, and the longest that is worth it.
CACHE_WORDS, CACHE_LENGTH = 600_000, 24
TOKENIZER = "word_bpe_49k.json"


class WordIds(dict):
    """Ids (little-endian 32-bit) of words between white space, each tokenised once and remembered up to
    a fixed number.  Right for tokenizers that drop white space and never join what it parts."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        spaces = [chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()]
        odd = [c for c in spaces if self.encode(f"a{c}b") != self.encode("a b")]
        self.odd = re.compile(f"[{''.join(odd)}]") if odd else None
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def encode(self, text: str) -> bytes:
        ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= CACHE_LENGTH and len(self) < CACHE_WORDS:
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        # white space to Python that the tokenizer keeps, or a token that it finds before it looks at words
        if self.odd and self.odd.search(text) or any(t in text for t in self.added):
            return self.encode(text)
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per Python worker and vocabulary file."""
    from tokenizers import Tokenizer

    return WordIds(Tokenizer.from_file(path))


class OpenBins:
    """At most ``most`` open bins of ``length``; ``free`` has bit f set while some bin has f free."""

    def __init__(self, length: int, most: int, close: Callable[[list, bool], None]):
        self.length, self.most, self.close = length, most, close
        self.by_free: list[list[list]] = [[] for _ in range(length + 1)]
        self.free, self.n = 0, 0

    def _take(self, free: int) -> list:
        at = self.by_free[free]
        bin_ = at.pop()
        if not at:
            self.free &= ~(1 << free)
        self.n -= 1
        return bin_

    def put(self, size: int, item) -> None:
        fitting = self.free >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(left)
        else:
            left, bin_ = self.length, []
        bin_.append((self.length - left, item))
        left -= size
        if not left:
            self.close(bin_, True)
            return
        self.by_free[left].append(bin_)
        self.free |= 1 << left
        self.n += 1
        if self.n > self.most:  # the fullest closes first
            self.close(self._take((self.free & -self.free).bit_length() - 1), True)

    def finish(self) -> None:
        while self.free:
            self.close(self._take((self.free & -self.free).bit_length() - 1), False)


_NAMES = ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset", "closed"]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]
SCHEMA = ("doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long, closed boolean")


def _packed(items: Iterator[tuple[int, tuple]], length: int, most: int, first_id: int) -> Iterator[pa.RecordBatch]:
    """Pack ``(size, (doc_id, piece, start, length, ids))`` and yield finished bins' rows."""
    rows: list[tuple] = []
    made = 0

    def close(bin_: list, done: bool) -> None:
        nonlocal made
        rows.extend((*item, first_id + made, offset, done) for offset, item in bin_)
        made += 1

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)
        rows.clear()
        return out

    bins = OpenBins(length, most, close)
    for size, item in items:
        bins.put(size, item)
        if len(rows) >= 2000:
            yield batch()
    bins.finish()
    if rows:
        yield batch()


def _first_id(phase: int) -> int:
    from pyspark import TaskContext

    return (phase << 60) + (TaskContext.get().partitionId() << 32)


def pack(docs: DataFrame, path: str, length: int = LENGTH, open_bins: int = OPEN) -> DataFrame:
    """``doc_id, piece, start, length, ids`` (little-endian 32-bit), ``sequence_id, offset`` of every piece."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
        words, end = word_ids(path), SEPARATOR.to_bytes(4, "little")
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = words.of(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at: at + 4 * length]
                    yield len(part) // 4, (doc_id, k, at // 4, len(part) // 4, part)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packed(pieces(batches), length, open_bins, _first_id(0))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = ((r[3], r) for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in _NAMES[:5])))
        yield from _packed(items, length, REST_OPEN, _first_id(1))

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    done = materialise(source.mapInArrow(first, SCHEMA), "packed")
    rest = done.where(~F.col("closed"))
    tasks = max(1, -(-rest.count() // REST_PIECES))
    rest = (rest.repartition(tasks, F.xxhash64("sequence_id", "offset"))
            .sortWithinPartitions(F.desc("length"), "sequence_id", "offset"))
    return done.where("closed").unionByName(rest.mapInArrow(again, SCHEMA)).drop("closed")


def with_digest(packed: DataFrame, ids: Column | str = "ids") -> DataFrame:
    return packed.select("doc_id", "piece", "start", "length", F.crc32(ids).alias("ids_crc32"), "sequence_id", "offset")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_digest(pack(read(spark, sf_dir, "documents"), tokenizer_path()))
