"""Words of whole texts as numpy arrays inside Arrow batches, and tables the operators share.

A batch of texts is one byte buffer with offsets. Words, their hashes and the hashes of word
n-grams are computed on that buffer in whole-array steps, about one megabyte of text at a time,
so a task holds a small multiple of that (or of its longest text) whatever the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.shared import broadcast_within, drop_scratch, scratch_path

__all__ = ["broadcast_within", "drop_scratch", "scratch_path", "ALPHANUMERIC", "Words", "word_chunks", "ngram_hashes", "rolling", "mix64", "small_batches", "stored", "keyed", "parted", "row_id"]

CHUNK_BYTES = 1 << 20
#: Bytes of rows that an Arrow function gets at a time. Spark's own limits, 10,000 rows or 64 MB, let an executor's buffers outside the heap
#: and those of its Python workers grow with the texts, and neither gives back what it had once.
BATCH_BYTES = 2 << 20
#: Ids that may be broadcast: 8 bytes each, so at most some tens of megabytes in an executor.
BROADCAST_IDS = 1_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(29))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: Separators: all ASCII but digits and letters.
ALPHANUMERIC = np.ones(256, dtype=bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[65:91] = ALPHANUMERIC[97:123] = False
ALPHANUMERIC[128:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of some consecutive texts of a batch.

    ``rows``: the texts' places in the batch. ``data``: their bytes, one buffer. ``text_at``: where each text
    begins and ends in it. ``start`` and ``stop``: the bytes of each word. ``first``: the number of words before each
    text and, last, of all. ``doc``: the text of each word, counted from 0. ``hash``: 64 bits for each word.
    """

    def __init__(self, rows: range, data: np.ndarray, text_at: np.ndarray, lower: bool, separators: np.ndarray):
        self.rows, self.text_at = rows, text_at
        self.data = data = _LOWER[data] if lower else data
        inside = ~separators[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = text_at[1:-1]
        edges = edges[edges < len(data)]
        begins[edges] = inside[edges]  # a word never runs on into the next text
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | begins[1:]
        self.start = np.flatnonzero(begins)
        self.stop = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, text_at)
        self.inside = inside
        self._doc: np.ndarray | None = None
        self._hash: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.start)

    @property
    def doc(self) -> np.ndarray:
        if self._doc is None:
            self._doc = np.repeat(np.arange(len(self.rows)), np.diff(self.first))
        return self._doc

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = self.prefix_hash(None)
        return self._hash

    def prefix_hash(self, n: int | None) -> np.ndarray:
        """64 bits for each word, or for its first ``n`` bytes."""
        if not len(self):
            return np.zeros(0, dtype=np.uint64)
        length = self.stop - self.start
        if n is not None:
            length = np.minimum(length, n)
        ahead = np.cumsum(length) - length
        within = np.arange(int(length.sum())) - np.repeat(ahead, length)
        at = within + np.repeat(self.start, length)
        value = (self.data[at].astype(np.uint64) + np.uint64(1)) * _powers(int(length.max()))[within]
        return mix64(np.add.reduceat(value, ahead) ^ (length.astype(np.uint64) << np.uint64(56)))

    def spaced(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words, or those to keep, each followed by one space: the bytes, and where each word begins and stops there."""
        start, stop = (self.start, self.stop) if keep is None else (self.start[keep], self.stop[keep])
        length = stop - start + 1
        ahead = np.cumsum(length) - length
        at = np.arange(int(length.sum())) - np.repeat(ahead, length) + np.repeat(start, length)
        out = self.data[np.minimum(at, max(len(self.data) - 1, 0))]
        out[ahead + length - 1] = 32
        return out, ahead, ahead + length - 1


def word_chunks(column: pa.Array, lower: bool = False, separators: np.ndarray = _SPACE) -> Iterator[Words]:
    """The texts of a column, null as empty, about a megabyte at a time."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data or b"", dtype=np.uint8)
    begin = 0
    while begin < len(column):
        end = int(np.searchsorted(at, at[begin] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, begin + 1), len(column))
        yield Words(range(begin, end), data[at[begin]: at[end]], at[begin: end + 1] - at[begin], lower, separators)
        begin = end


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """64 bits for each ``n`` consecutive values, whatever text they are of."""
    m = max(len(h) - n + 1, 0)
    total = h[:m].copy()
    for j in range(1, n):
        total *= _STEP
        total += h[j: j + m]
    return mix64(total)


def ngram_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word at which ``n`` words of one text begin: its index, and 64 bits for the ``n`` words."""
    total = rolling(words.hash, n)
    at = np.flatnonzero(words.doc[: len(total)] == words.doc[n - 1:])
    return at, total[at]


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Meanwhile what runs hands its Arrow functions ``BATCH_BYTES`` of rows at a time; a limit that the session was given holds."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name in spark.conf.getAll:
        yield
        return
    spark.conf.set(name, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(name)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read again, and where: it survives a lost executor and cuts the plan.

    Its Arrow functions run here, in small batches.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def row_id() -> Column:
    """64 bits for ``doc_id`` and ``text``: rows equal in both are one document."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.isnull("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (null as empty) and ``rid``, as ``row_id`` gives it."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), row_id().alias("rid"))


def parted(docs: DataFrame, rids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` whose ``rid`` is in ``rids`` (a column rid, distinct), and the others.

    The ids are broadcast only when counted and few; otherwise both sides are shuffled.
    """
    held = broadcast_within(rids, BROADCAST_IDS)
    return docs.join(held, "rid", "left_semi"), docs.join(held, "rid", "left_anti")
