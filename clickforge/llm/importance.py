"""Target-distribution importance resampling over hashed word n-grams, with crc32 from a position table.

crc32 is linear: the register of a span is the XOR of one contribution for each byte, which depends on the byte and on its distance
from the span's end only, and of a constant for the span's length. ``PositionCrc`` looks the contributions of all bytes of many spans
up in one table and folds them with ``bitwise_xor.reduceat``. The table reaches ``REACH`` bytes back; longer spans are cut into blocks
of that length, and the register of the blocks before is moved on over a block with four more look-ups in the same table.

Both corpora are counted into buckets by their tasks; a bucket's gain is the scaled log ratio of its smoothed shares. The gains, one
integer for each bucket, go back to the tasks, which weigh every document. Drawing is a Gumbel top-k: a document's score is its
weight and a noise that its id fixes, and the highest scores are drawn. Ranks come from a sort by range over all partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import ALPHANUMERIC, Words, drop_scratch, stored, word_chunks

REACH = 64
#: Bytes that are looked up together.
STEP_BYTES = 1 << 20
#: monotonically_increasing_id has the partition above these bits and the row's place in it below.
PLACE_BITS = 33


class PositionCrc:
    """crc32 (reflected 0xEDB88320, as zlib's) of many spans of one buffer."""

    def __init__(self, reach: int = REACH):
        if reach < 4:
            raise ValueError("the register has four bytes, so the table must reach as far")
        self.reach = reach
        step = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            step = (step >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (step & np.uint32(1)))
        rows = [step]
        for _ in range(reach - 1):
            rows.append((rows[-1] >> np.uint32(8)) ^ step[rows[-1] & np.uint32(255)])
        #: The contribution of a byte, by its distance from the end and its value, in one row.
        self.table = np.concatenate(rows)
        self.constant = np.array([zlib.crc32(bytes(n)) for n in range(reach + 1)], dtype=np.uint32)

    def _raw(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The XOR of the contributions of each span's bytes; no span is empty or longer than the table reaches."""
        out = np.empty(len(start), dtype=np.uint32)
        ends = np.cumsum(stop - start)
        begin = 0
        while begin < len(start):
            done = int(ends[begin - 1]) if begin else 0
            end = max(int(np.searchsorted(ends, done + STEP_BYTES, side="right")), begin + 1)
            a, z = start[begin:end], stop[begin:end]
            size = z - a
            ahead = np.cumsum(size) - size
            at = np.arange(int(size.sum())) + np.repeat(a - ahead, size)
            distance = np.repeat(z - 1, size) - at
            out[begin:end] = np.bitwise_xor.reduceat(self.table[distance << 8 | data[at]], ahead)
            begin = end
        return out

    def _moved(self, register: np.ndarray) -> np.ndarray:
        """The registers after ``reach`` more zero bytes."""
        out = np.zeros_like(register)
        for i in range(4):
            byte = (register >> np.uint32(8 * i)) & np.uint32(255)
            out ^= self.table[(self.reach - 1 - i) << 8 | byte.astype(np.int64)]
        return out

    def of(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """crc32 of ``data[start:stop]`` for each pair; spans may overlap but not be empty."""
        size = stop - start
        out = np.empty(len(start), dtype=np.uint32)
        short = size <= self.reach
        near = np.flatnonzero(short)
        out[near] = self._raw(data, start[near], stop[near]) ^ self.constant[size[near]]
        far = np.flatnonzero(~short)
        if len(far):
            blocks = -(-size[far] // self.reach)
            lead = np.cumsum(blocks) - blocks
            behind = np.repeat(blocks, blocks) - 1 - (np.arange(int(blocks.sum())) - np.repeat(lead, blocks))
            z = np.repeat(stop[far], blocks) - behind * self.reach  # blocks end at the span's end, so only the first is short
            a = np.maximum(z - self.reach, np.repeat(start[far], blocks))
            raw = self._raw(data, a, z)
            register = raw[lead]
            for k in range(1, int(blocks.max())):
                on = np.flatnonzero(blocks > k)
                register[on] = self._moved(register[on]) ^ raw[lead[on] + k]
            lengths, which = np.unique(size[far], return_inverse=True)
            constant = np.array([zlib.crc32(bytes(int(n))) for n in lengths], dtype=np.uint32)
            out[far] = register ^ constant[which]
        return out


def _buckets(words: Words, crc: PositionCrc, size: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of every run of 1, then 2, ... ``size`` words of one text, joined by one space."""
    if not len(words):
        return
    flat, start, stop = words.spaced()
    for n in range(1, size + 1):
        at = np.flatnonzero(words.doc[: len(words) - n + 1] == words.doc[n - 1:])
        yield words.doc[at], (crc.of(flat, start[at], stop[at + n - 1]) % np.uint32(buckets)).astype(np.int64)


def bucket_counts(texts: DataFrame, column: str = "text", size: int = 2, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket; tasks send one row for each bucket they meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, total = PositionCrc(), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for words in word_chunks(batch.column(0), lower=True, separators=ALPHANUMERIC):
                for _, bucket in _buckets(words, crc, size, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    counted = texts.select(F.col(column).cast("string")).mapInArrow(run, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = 10_000, scale: int = 1000) -> list[int]:
    """The gain of each bucket, from two ``bucket_counts``: the floored, scaled log ratio of the shares, both smoothed by one."""
    of = lambda df, name: df.select(F.col("bucket").alias("b"), F.col("n").alias(name))
    every = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"))
    both, path = stored(every.join(of(source, "s"), "b", "left").join(of(target, "t"), "b", "left").fillna(0, ["s", "t"]), "buckets")
    total = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    d = lambda name, plus: (F.col(name) + plus).cast("double")
    ratio = d("t", 1) * F.lit(float(total.s + buckets)) / (d("s", 1) * F.lit(float(total.t + buckets)))
    gain = F.floor(F.lit(float(scale)) * F.ln(ratio)).cast("long").alias("gain")
    gains = [r.gain for r in both.select("b", gain).orderBy("b").collect()]  # one row for each bucket
    drop_scratch(source.sparkSession, path)
    return gains


def weighed(docs: DataFrame, gains: list[int], size: int = 2) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row: ``weight`` is the floored mean gain of its features, 0 without any."""
    shared = docs.sparkSession.sparkContext.broadcast(np.array(gains, dtype=np.float64))  # one number for each bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, crc = shared.value, PositionCrc()
        for batch in batches:
            for words in word_chunks(batch.column(1), lower=True, separators=ALPHANUMERIC):
                n = len(words.rows)
                total, features = np.zeros(n), np.zeros(n, dtype=np.int64)
                for doc, bucket in _buckets(words, crc, size, len(gain)):
                    total += np.bincount(doc, gain[bucket], minlength=n)  # whole numbers below 2 ** 53
                    features += np.bincount(doc, minlength=n)
                weight = np.where(features > 0, total.astype(np.int64) // np.maximum(features, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(words.rows.start, n), pa.array(np.diff(words.first).astype(np.int64)), pa.array(features), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = 7, scale: int = 1000) -> Column:
    """A draw from the scaled, floored Gumbel distribution that the id and the seed fix."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-float(scale)) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, size: int = 2, buckets: int = 10_000, seed: int = 7,
    scale: int = 1000,
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text; further columns are ignored) with its weight towards ``target`` (text) and its rank in the draw.

    Returns doc_id, n_words, n_features, weight, score and rank. Texts are lower-cased (A-Z) and cut into words at ASCII characters
    other than digits and letters; features are all runs of 1 to ``size`` words, repeats counted, by the crc32 of their UTF-8 bytes modulo
    ``buckets``. Of the rows with at least ``min_words`` words, the ``percent`` of a hundred (floored) with the highest scores are
    drawn and numbered from 1, ties by ascending doc_id, null ids first; the rest have a null rank. Null and empty texts have no
    features and weight 0. Rows that repeat a doc_id are documents of their own with the same noise. An empty target gives
    gains from the smoothing alone; an empty corpus no rows.
    """
    if size < 1 or buckets < 1 or not 0 <= percent <= 100:
        raise ValueError("size and buckets are at least 1, percent is from 0 to 100")
    gains = bucket_gains(bucket_counts(docs, "text", size, buckets), bucket_counts(target, "text", size, buckets), buckets, scale)
    scored, _ = stored(weighed(docs, gains, size).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed, scale)), "scored")
    n = scored.where(F.col("n_words") >= min_words).count()
    order = [F.desc("score"), F.asc("doc_id"), F.asc("row")]  # "row" deals out rows that repeat an id
    sorted_rows, _ = stored(
        scored.where(F.col("n_words") >= min_words).withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*order).sortWithinPartitions(*order).drop("row").withColumn("place", F.monotonically_increasing_id()), "drawn")
    part = F.shiftright("place", PLACE_BITS)
    ahead, offsets = 0, []
    for r in sorted_rows.groupBy(part.alias("part")).count().orderBy("part").collect():  # one row for each partition
        offsets.append((r.part, ahead))
        ahead += r["count"]
    starts = scored.sparkSession.createDataFrame(offsets, "part long, ahead long")
    rank = F.col("ahead") + F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + 1
    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    ranked = sorted_rows.join(F.broadcast(starts), part == F.col("part")).select(
        *names, F.when(rank <= F.lit(percent * n // 100), rank).cast("long").alias("rank"))
    rest = scored.where(F.col("n_words") < min_words).select(*names, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)
