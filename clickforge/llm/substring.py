"""Substring dedup: suffix automata of reference shards, streamed for matching statistics.

A passage of ``window`` words is removed where it also occurs in an earlier document. One automaton of the corpus, or its
broadcast to every task, would grow with the data, so the reference is cut into shards by content: a window belongs to the
shard of the least hash among its word k-grams (winnowing). Equal windows have equal least hashes, so every possible match
meets in one shard, and windows whose k-gram no second document has are never sent anywhere. A shard's automaton holds the
words of its distinct segments in document order; a segment is first streamed through the automaton of the earlier
documents, where a match of ``window`` words or more marks its end, and then added to it.

A k-gram that very many documents have (``hot``) would make a large shard. Its windows become shards of their own, one for
each distinct window, and equal segments meet as one row with their smallest doc_id, so no shard holds a row per copy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import BROADCAST_IDS, Words, broadcast_within, drop_scratch, rolling, stored, word_chunks

GRAM = 5
HOT = 5_000


class SuffixAutomaton:
    """Suffix automaton of several word sequences."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, sequence: list[bytes]) -> None:
        """Add a sequence; its factors and those of earlier ones are then found by ``streamed``."""
        last = 0
        for word in sequence:
            last = self._extend(last, word)

    def _extend(self, last: int, word: bytes) -> int:
        step, link, length = self.next, self.link, self.length
        if (q := step[last].get(word)) is not None:
            return q if length[q] == length[last] + 1 else self._clone(last, q, word)
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p >= 0:
            q = step[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, word)
        return new

    def _clone(self, p: int, q: int, word: bytes) -> int:
        step, link, length = self.next, self.link, self.length
        copy = len(step)
        step.append(dict(step[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p >= 0 and step[p].get(word) == q:
            step[p][word] = copy
            p = link[p]
        return copy

    def streamed(self, sequence: list[bytes]) -> list[int]:
        """Matching statistics: for each place, how many words up to it the automaton's sequences share at most."""
        step, link, length = self.next, self.link, self.length
        state = matched = 0
        out = []
        for word in sequence:
            while word not in step[state] and state:
                state = link[state]
                matched = length[state]
            if word in step[state]:
                state = step[state][word]
                matched += 1
            out.append(matched)
        return out


def _least(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word at which a window of one text begins: its index, and the least k-gram hash in the window."""
    g = rolling(words.hash, gram)
    low, have, want = g, 1, window - gram + 1
    while have < want:
        step = min(have, want - have)
        low = np.minimum(low[: max(len(low) - step, 0)], low[step:])
        have += step
    at = np.flatnonzero(words.doc[: len(low)] == words.doc[window - 1:])
    return at, low[at].view(np.int64)


def fingerprints(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(fp, doc_id): the distinct least hashes of each text's windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for words in word_chunks(batch.column(1)):
                at, low = _least(words, window, gram)
                doc = words.doc[at]
                new = np.ones(len(at), dtype=bool)
                new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
                low, doc = low[new], doc[new]
                order = np.lexsort((low, doc))
                low, doc = low[order], doc[order]
                new = np.ones(len(low), dtype=bool)
                new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(low[new]), pa.array(ids[words.rows.start: words.rows.stop][doc[new]])], names=["fp", "doc_id"])

    return docs.select("doc_id", "text").mapInArrow(run, "fp long, doc_id long")


def _segments(candidates: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc_id, tid, at, n, shard, sid, words): runs of ``n`` windows that share their least hash, where another text has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            tids = batch.column(1).to_numpy(zero_copy_only=False)
            shared, hot = batch.column(3), batch.column(4)
            for words in word_chunks(batch.column(2)):
                begin, low = _least(words, window, gram)
                doc = words.doc[begin]
                cut = np.searchsorted(doc, np.arange(len(words.rows) + 1))
                some, alone = np.zeros(len(begin), dtype=bool), np.zeros(len(begin), dtype=bool)
                for i, row in enumerate(words.rows):
                    part = low[cut[i]: cut[i + 1]]
                    some[cut[i]: cut[i + 1]] = np.isin(part, shared[row].values.to_numpy())
                    if len(hot[row]):
                        alone[cut[i]: cut[i + 1]] = np.isin(part, hot[row].values.to_numpy())
                begin, low, doc, alone = begin[some], low[some], doc[some], alone[some]
                if not len(begin):
                    continue
                new = np.ones(len(begin), dtype=bool)
                new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1]) | (begin[1:] != begin[:-1] + 1) | alone[1:]
                lead = np.flatnonzero(new)
                n = np.diff(np.append(lead, len(begin)))
                at, doc, alone = begin[lead], doc[lead], alone[lead]
                span = n + window - 1
                # 64 bits for the words of a segment: sums of word hashes times powers, shifted to the segment's start
                place = np.repeat(at, span) + np.arange(int(span.sum())) - np.repeat(np.cumsum(span) - span, span)
                within = place - np.repeat(at, span)
                odd = np.cumprod(np.full(int(span.max()), 0x9E3779B97F4A7C15, dtype=np.uint64))
                sid = np.add.reduceat(words.hash[place] * odd[within], np.cumsum(span) - span) + span.astype(np.uint64)
                shard = np.where(alone, rolling(words.hash, window)[at].view(np.int64), low[lead])
                flat, start, stop = words.spaced()
                size = stop[at + span - 1] - start[at]
                ends = np.concatenate([[0], np.cumsum(size)])
                take = np.arange(int(size.sum())) - np.repeat(ends[:-1], size) + np.repeat(start[at], size)
                text = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat[take])])
                first = words.first[doc]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[words.rows.start: words.rows.stop][doc]), pa.array(tids[words.rows.start: words.rows.stop][doc]),
                    pa.array((at - first).astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(shard), pa.array(sid.view(np.int64)),
                    text.cast(pa.binary())], names=["doc_id", "tid", "at", "n", "shard", "sid", "words"])

    return candidates.select("doc_id", "tid", "text", "shared", "hot").mapInArrow(
        run, "doc_id long, tid long, at int, n int, shard long, sid long, words binary")


def _streamed(segments: DataFrame, window: int) -> DataFrame:
    """(shard, sid, found) for the distinct segments (shard, sid, first, words): which of its windows an earlier document has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = automaton = doc = None
        waiting: list[list[bytes]] = []
        for batch in batches:
            out: list[tuple] = []
            for k, sid, first, text in zip(*(c.to_pylist() for c in batch.columns)):
                if k != shard:
                    shard, automaton, doc, waiting = k, SuffixAutomaton(), first, []
                if first != doc:
                    for sequence in waiting:
                        automaton.add(sequence)
                    doc, waiting = first, []
                sequence = text.split(b" ")
                waiting.append(sequence)
                if found := [i - window + 1 for i, x in enumerate(automaton.streamed(sequence)) if x >= window]:
                    out.append((k, sid, found))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int32())))],
                    names=["shard", "sid", "found"])

    return segments.repartition("shard").sortWithinPartitions("shard", "first", "sid").select(
        "shard", "sid", "first", "words").mapInArrow(run, "shard long, sid long, found array<int>")


def _cut(docs: DataFrame, window: int) -> DataFrame:
    """The results of ``docs`` (doc_id, text, copy, marks): ``marks`` names windows; a copy loses every window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copy = batch.column(2).to_numpy(zero_copy_only=False)
            for words in word_chunks(batch.column(1)):
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for i, row in enumerate(words.rows):
                    lo, hi = words.first[i], words.first[i + 1]
                    if copy[row]:
                        starts = np.array([lo]) if hi - lo >= window else np.zeros(0, dtype=np.int64)
                        stops = np.full(len(starts), hi)
                    else:
                        marks = batch.column(3)[row].values
                        starts = (marks.to_numpy().astype(np.int64) if marks is not None else np.zeros(0, dtype=np.int64)) + lo
                        stops = starts + window
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, stops, -1)
                gone = np.cumsum(gone)[:-1] > 0
                flat, start, stop = words.spaced(~gone)
                kept_first = np.concatenate([[0], np.cumsum(~gone)])[words.first]
                ids, n_words, n_removed, spans, kept = [], [], [], [], []
                for i, row in enumerate(words.rows):
                    lo, hi = words.first[i], words.first[i + 1]
                    a, b = kept_first[i], kept_first[i + 1]
                    n_words.append(hi - lo)
                    n_removed.append(hi - lo - (b - a))
                    kept.append(flat[start[a]: stop[b - 1]].tobytes().decode() if b > a else "")
                    if n_removed[-1]:
                        mine = np.concatenate([[0], gone[lo:hi].astype(np.int8), [0]])
                        edge = np.diff(mine)
                        spans.append([{"start": int(x), "stop": int(y)} for x, y in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0))])
                    else:
                        spans.append([])
                    ids.append(row)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(ids, pa.int64())), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "removed", "kept"])

    return docs.select("doc_id", "text", "copy", "marks").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, removed array<struct<start:int,stop:int>>, kept string")


def remove_repeats(docs: DataFrame, window: int = 13, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Every row of ``docs`` (doc_id, text; further columns are ignored) without passages that an earlier document has.

    Returns doc_id, n_words, n_removed, removed (word spans, from start up to stop) and kept (the other words, joined by one
    space). A word is removed if one of the ``window``-word windows over it, as the input has them, also occurs in a document
    with a smaller doc_id. Null and empty texts have no words and an empty ``kept``. Rows with the same doc_id never remove
    each other's words. A row without doc_id keeps all and removes nothing from others.
    """
    if not 1 <= gram <= window:
        raise ValueError("a k-gram must fit into the window")
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("tid", F.xxhash64("text"))
    known = docs.where("doc_id is not null")

    whole = known.select("doc_id", "tid", F.unhex(F.md5("text")).alias("digest"))
    firsts = whole.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies, _ = stored(whole.join(firsts, "digest").where("doc_id > first").select("doc_id", "tid").distinct(), "copies")
    rows = ["doc_id", "tid"]
    originals = known.join(broadcast_within(copies, BROADCAST_IDS), rows, "left_anti")

    prints = fingerprints(originals, window, gram)
    common = prints.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1")
    shared = prints.join(common, "fp").groupBy("doc_id").agg(
        F.collect_set("fp").alias("shared"), F.collect_set(F.when(F.col("n") > hot, F.col("fp"))).alias("hot"))
    shared, shared_at = stored(shared, "shared")
    candidates = originals.join(broadcast_within(shared.select("doc_id"), BROADCAST_IDS), "doc_id", "left_semi").join(shared, "doc_id")
    found, found_at = stored(_segments(candidates, window, gram), "segments")
    drop_scratch(spark, shared_at)

    least, least_at = stored(found.groupBy("shard", "sid").agg(F.min("doc_id").alias("first")), "firsts")
    several = least.groupBy("shard").count().where("count > 1").select("shard")
    streams = (
        found.select("shard", "sid", F.col("doc_id").alias("first"), "words")
        .join(least.join(several, "shard", "left_semi"), ["shard", "sid", "first"]).dropDuplicates(["shard", "sid"])
    )
    earlier = _streamed(streams, window)
    every = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: i + F.col("at"))
    some = F.transform("found", lambda i: i + F.col("at"))
    marks = (
        found.drop("words").join(least, ["shard", "sid"]).join(earlier, ["shard", "sid"], "left")
        .withColumn("marks", F.when(F.col("doc_id") > F.col("first"), every).otherwise(some)).where("marks is not null")
        .groupBy(*rows).agg(F.flatten(F.collect_list("marks")).alias("marks"))
    )
    marks, _ = stored(marks, "marks")
    drop_scratch(spark, found_at)
    drop_scratch(spark, least_at)
    touched = originals.join(broadcast_within(marks.select(*rows), BROADCAST_IDS), rows, "left_semi").join(marks, rows).select(
        "doc_id", "text", F.lit(False).alias("copy"), "marks")
    nothing = F.lit(None).cast("array<int>").alias("marks")
    plain = docs.join(broadcast_within(marks.select(*rows), BROADCAST_IDS), rows, "left_anti").join(
        broadcast_within(copies.withColumn("copy", F.lit(True)), BROADCAST_IDS), rows, "left"
    ).select("doc_id", "text", F.coalesce("copy", F.lit(False)).alias("copy"), nothing)
    return _cut(plain.unionByName(touched), window)
