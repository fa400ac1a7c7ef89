"""Ranked lexical search: hashed max-sketches bound every score, and only documents whose bound can still win are scored exactly.

A document's terms have impacts, whole numbers that grow with the term's count and fall with the document's length; a query scores
a document by the sum of its terms' weights times their impacts. A document's sketch has ``COORDINATES`` places; each of its terms
is hashed to one of them, and a place keeps the greatest impact that falls on it. A term's impact is never above its place, so looking
a query's terms up in the sketch gives an upper bound of the score, of many documents at once. For each query a task goes through the
documents at hand by falling bound, scores them exactly, keeps the best, and stops at the first bound below the worst it keeps.

The queries are a stated set. They go to the tasks in blocks of about ``BLOCK_ITEMS``, each block one pass over the corpus, so what a
task holds does not grow with their number: the block's terms, the best few of each query, and one chunk of documents. Tasks send the
best of each query on; two levels of ranking merge them, so that no task gets the lists of all others for one query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickforge.llm.common import ALPHANUMERIC, Words, stored, word_chunks

COORDINATES = 4096
BLOCK_ITEMS = 1024
#: Documents whose sketches are held together, and candidates that are scored together.
SLICE, STEP = 1024, 32
SALTS = 32
LAST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Queries:
    """A block of queries. ``terms``: the sorted hashes of all their terms. ``of``: for each query its row number and its terms' places in ``terms``."""

    terms: np.ndarray
    of: list[tuple[int, np.ndarray]]

    @classmethod
    def read(cls, rows: list[int], texts: list[str | None]) -> Queries:
        held = []
        for words in word_chunks(pa.array(texts, pa.string()), lower=True, separators=ALPHANUMERIC):
            held += [(rows[row], np.unique(words.hash[words.first[i]: words.first[i + 1]])) for i, row in enumerate(words.rows)]
        terms = np.unique(np.concatenate([h for _, h in held])) if held else np.zeros(0, dtype=np.uint64)
        return cls(terms, [(row, np.searchsorted(terms, h)) for row, h in held if len(h)])


def _terms(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term hash, count) of the distinct terms of each text, ordered by both."""
    order = np.lexsort((words.hash, words.doc))
    doc, term = words.doc[order], words.hash[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    return doc[at], term[at], np.diff(np.append(at, len(doc)))


def corpus_statistics(docs: DataFrame, queries: Queries) -> tuple[int, int, np.ndarray]:
    """The number of texts with a term, the number of all terms with repeats, and for each query term how many texts have it."""
    shared = docs.sparkSession.sparkContext.broadcast(queries.terms)  # a block's terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        total = np.zeros(len(known) + 2, dtype=np.int64)
        for batch in batches:
            for words in word_chunks(batch.column(0), lower=True, separators=ALPHANUMERIC):
                total[-2] += np.count_nonzero(np.diff(words.first))
                total[-1] += len(words)
                if not len(known) or not len(words):
                    continue
                place = np.searchsorted(known, words.hash)
                place[place == len(known)] = 0
                some = np.flatnonzero(known[place] == words.hash)
                both = np.unique(words.doc[some] * len(known) + place[some])
                total[:-2] += np.bincount(both % len(known), minlength=len(known))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["place", "n"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    total = np.zeros(len(queries.terms) + 2, dtype=np.int64)
    for r in counted.collect():  # one row for each term of the block
        total[r.place] = r.n
    return int(total[-2]), int(total[-1]), total[:-2]


def term_weights(with_term: np.ndarray, texts: int) -> np.ndarray:
    """The whole-number weight of each term, from the number of texts that have it."""
    return np.array([math.floor(1000 * math.log((2 * texts + 2) / (2 * int(df) + 1))) for df in with_term], dtype=np.int64)


class _Best:
    """The best documents of one query that a task has met, best first."""

    __slots__ = ("scores", "ids", "top")

    def __init__(self, top: int):
        self.top = top
        self.scores, self.ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    @property
    def least(self) -> int:
        """The score a document must reach to be of interest."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        some = scores >= self.least
        scores, ids = np.concatenate([self.scores, scores[some]]), np.concatenate([self.ids, ids[some]])
        order = np.lexsort((ids, -scores))[: self.top]
        self.scores, self.ids = scores[order], ids[order]


class Sketches:
    """The sketches of some texts of a chunk, and their impacts on the query terms for exact scores."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n: int, terms: np.ndarray, coordinates: int):
        shift = np.uint64(64 - (coordinates.bit_length() - 1))
        of_terms = (terms >> shift).astype(np.int64) if coordinates > 1 else np.zeros(len(terms), dtype=np.int64)
        self.used, self.place = np.unique(of_terms, return_inverse=True)  # places that no query looks up need no memory
        row = np.full(coordinates, -1)
        row[self.used] = np.arange(len(self.used))
        at = row[(term >> shift).astype(np.int64)] if coordinates > 1 else np.zeros(len(term), dtype=np.int64)
        some = np.flatnonzero(at >= 0)
        # One row for each place, so that a query's look-up reads whole rows.
        self.greatest = np.zeros((len(self.used), n))
        np.maximum.at(self.greatest.reshape(-1), at[some] * n + doc[some], impact[some])
        which = np.searchsorted(terms, term)
        which[which == len(terms)] = 0
        known = np.flatnonzero(terms[which] == term)
        self.which, self.impact = which[known], impact[known]
        self.first = np.searchsorted(doc[known], np.arange(n + 1))

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """An upper bound of each text's score; sums of whole numbers below 2 ** 53."""
        return weights.astype(np.float64) @ self.greatest[self.place[terms]]

    def scores(self, texts: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """The exact scores of ``texts``; ``weight_of`` has the query's weight of every term of the block, 0 for others' terms."""
        size = self.first[texts + 1] - self.first[texts]
        ahead = np.cumsum(size) - size
        at = np.arange(int(size.sum())) - np.repeat(ahead, size) + np.repeat(self.first[texts], size)
        running = np.concatenate([[0], np.cumsum(weight_of[self.which[at]] * self.impact[at])])
        return running[ahead + size] - running[ahead]


def _ranked(sketches: Sketches, ids: np.ndarray, terms: np.ndarray, weights: np.ndarray, best: _Best, weight_of: np.ndarray) -> None:
    """Score the texts by falling bound until no bound can win any more."""
    bounds = sketches.bounds(terms, weights)
    order = np.flatnonzero(bounds >= best.least)
    if not len(order):
        return
    order = order[np.argsort(-bounds[order], kind="stable")]
    weight_of[terms] = weights
    for begin in range(0, len(order), STEP):
        if bounds[order[begin]] < best.least:
            break
        texts = order[begin: begin + STEP]
        best.add(sketches.scores(texts, weight_of), ids[texts])
    weight_of[terms] = 0


def _block(docs: DataFrame, queries: Queries, top: int, coordinates: int) -> DataFrame:
    """(query, doc_id, score): the best documents of each task for each query of the block."""
    texts, length, with_term = corpus_statistics(docs, queries)
    shared = docs.sparkSession.sparkContext.broadcast((queries, term_weights(with_term, texts)))  # a block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        found = [_Best(top) for _ in queries.of]
        weight_of = np.zeros(len(queries.terms), dtype=np.int64)
        for batch in batches:
            ids = batch.column(0).fill_null(int(LAST)).to_numpy(zero_copy_only=False)
            for words in word_chunks(batch.column(1), lower=True, separators=ALPHANUMERIC):
                if not len(words):
                    continue
                doc, term, count = _terms(words)
                m = 10 + 90 * np.diff(words.first).astype(np.int64) * texts // length
                impact = 1_000_000_000 * count // (1000 * count + 8 * m[doc])
                mine = ids[words.rows.start: words.rows.stop]
                for lo in range(0, len(mine), SLICE):
                    a, z = np.searchsorted(doc, [lo, lo + SLICE])
                    part = Sketches(doc[a:z] - lo, term[a:z], impact[a:z], len(mine[lo: lo + SLICE]), queries.terms, coordinates)
                    for (_, terms), best in zip(queries.of, found):
                        _ranked(part, mine[lo: lo + SLICE], terms, weights[terms], best, weight_of)
        rows = [row for (row, _), best in zip(queries.of, found) for _ in best.ids]
        ids = np.concatenate([best.ids for best in found]) if found else np.zeros(0, dtype=np.int64)
        scores = np.concatenate([best.scores for best in found]) if found else np.zeros(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(ids, mask=ids == LAST), pa.array(scores)], names=["query", "doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "query long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = 10, coordinates: int = COORDINATES, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` rows of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text).

    Further columns of both are ignored. Terms are cut at ASCII characters other than digits and letters, A-Z lower-cased; two
    terms are the same if 64 bits of hash are. ``rank`` counts from 1, the highest score first, equal scores by ascending doc_id, null
    ids last. Rows with score 0 are left out. Null and empty texts have no terms: as documents they count for nothing, as
    items they have no rows. Rows that repeat a doc_id are documents of their own; rows that repeat an item_id are queries of
    their own, each with its ranks. Empty tables on either side give no rows. ``coordinates`` is a power of two.
    """
    if top < 1 or block_items < 1 or coordinates < 1 or coordinates & (coordinates - 1):
        raise ValueError("top and block_items are at least 1, coordinates a power of two")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    numbered, _ = stored(items.select("item_id", F.col("text").cast("string")).withColumn("query", F.monotonically_increasing_id()), "items")
    blocks = max(1, -(-numbered.count() // block_items))
    parts = []
    for b in range(blocks):
        rows = numbered.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b).select("query", "text").collect()  # about block_items rows
        queries = Queries.read([r.query for r in rows], [r.text for r in rows])
        if queries.of:
            parts.append(stored(_block(docs, queries, top, coordinates), "best")[0])
    if not parts:
        return numbered.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
    best = parts[0]
    for part in parts[1:]:
        best = best.unionByName(part)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = best.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.drop("rank").withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(numbered.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
