"""Toxicity: a counterfactual-regularised logistic classifier.

Features are the presence of words and of word beginnings, hashed. For every labelled text that has terms of a kind, counterfactual
texts have other terms of the same kind instead; training penalises the squared change of the score's log-odds between both,
so which of them a text names cannot carry a verdict. Kinds are a list of English group terms and, in any language, terms that the
labelled texts use between the same neighbours with label shares that do not differ. The fit runs on at most ``max_rows`` labelled
rows, the smallest by a hash of doc_id; features are hashed by the executors, and only those that enough of these rows have are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import Words, word_chunks

BITS = 20
MAX_ROWS = 12_000
MAX_FEATURES = 400
PREFIXES = (4, 5, 6)

#: Words of the labelled rows that may join a kind, the most frequent ones; texts a word must stand in.
MAX_TERMS = 1_000
TERM_TEXTS = 20
#: Cosine of two terms' neighbours from which they are of one kind, and deviations at which their label shares differ.
SAME_CONTEXTS = 0.6
SAME_SHARE = 1.64
#: Counterfactual texts of one text; in version v a term is swapped for the v-th after it in its kind.
VERSIONS = 3

#: Terms that name groups, by kind.
IDENTITY = (
    ("men", "women"), ("man", "woman"), ("boys", "girls"), ("male", "female"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"), ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"), ("gay", "lesbian", "straight", "transgender", "bisexual"),
    ("american", "african", "european", "mexican", "chinese", "indian"), ("immigrants", "refugees", "citizens"),
    ("old", "young"), ("blind", "deaf", "disabled"),
)
_WORD = re.compile(r"[^\W\d_]+")

_LETTERS = np.ones(256, dtype=bool)  # separators: all ASCII but digits and letters
_LETTERS[48:58] = _LETTERS[65:91] = _LETTERS[97:123] = False
_LETTERS[128:] = False


def swaps(kinds: Sequence[Sequence[str]], versions: int = VERSIONS) -> list[dict[str, str]]:
    """For each version, what every term is swapped for. A term of two kinds belongs to the first; kinds of one term have no swap."""
    out = []
    for v in range(1, versions + 1):
        table: dict[str, str] = {}
        for kind in kinds:
            for i, term in enumerate(kind):
                if v < len(kind):
                    table.setdefault(term, kind[(i + v) % len(kind)])
        out.append(table)
    return out


def counterfactual(text: str | None, table: dict[str, str]) -> str | None:
    """The text with each term swapped as ``table`` says; None without such a term."""
    found = 0

    def other(m: re.Match) -> str:
        nonlocal found
        to = table.get(m[0].lower())
        found += to is not None
        return m[0] if to is None else to

    swapped = _WORD.sub(other, text or "")
    return swapped if found else None


def kinds_of_terms(labelled: DataFrame, max_terms: int = MAX_TERMS) -> list[list[str]]:
    """Kinds of terms that ``labelled`` (toxic, text; a bounded sample) itself shows.

    Two terms are of one kind if their neighbours, the word before and the word after, are distributed alike (cosine of the
    root counts) and the share of toxic texts among those with the one does not differ from that with the other by the
    two-proportion test. A kind grows from its most frequent term and takes what fits that term; each term is in one kind.
    Terms are the ``max_terms`` words in most texts, of at least ``TERM_TEXTS``. Executors count; the driver gets the counts of
    terms and of pairs of terms, at most ``max_terms`` squared, whatever the sample's size.
    """
    words = F.transform(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0)), F.lower)
    texts = labelled.select("toxic", words.alias("w"))
    counts = texts.select("toxic", F.explode(F.array_distinct("w")).alias("term")).groupBy("term").agg(F.count("*").alias("n"), F.sum("toxic").alias("pos"))
    terms = counts.where(F.col("n") >= TERM_TEXTS).orderBy(F.desc("n"), "term").limit(max_terms).collect()
    if len(terms) < 2:
        return []
    known = labelled.sparkSession.createDataFrame([(r["term"], i) for i, r in enumerate(terms)], "term string, id int")  # at most max_terms rows
    both = texts.select(F.explode(F.arrays_zip(F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))).alias("a"), F.slice("w", 2, 1 << 30).alias("b"))).alias("p"))
    pairs = both.groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).count()
    left, right = known.select(F.col("term").alias("a"), F.col("id").alias("i")), known.select(F.col("term").alias("b"), F.col("id").alias("j"))
    found = pairs.join(F.broadcast(left), "a").join(F.broadcast(right), "b").select("i", "j", "count").collect()
    m = len(terms)
    near = np.zeros((m, 2 * m), dtype=np.float32)
    for i, j, c in found:
        near[i, m + j] = near[j, i] = c ** 0.5
    near /= np.maximum(np.sqrt((near * near).sum(axis=1, keepdims=True)), 1e-9)
    n, pos = np.array([r["n"] for r in terms], dtype=float), np.array([r["pos"] for r in terms], dtype=float)
    kinds, free = [], np.ones(m, dtype=bool)
    for i in range(m):
        if not free[i]:
            continue
        share = (pos[i] + pos) / (n[i] + n)
        gap = np.abs(pos[i] / n[i] - pos / n) / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n[i] + 1 / n))
        like = np.flatnonzero(free & (near @ near[i] >= SAME_CONTEXTS) & (gap < SAME_SHARE))
        free[i] = False
        if len(like) > 1:
            free[like] = False
            kinds.append([terms[k]["term"] for k in like])
    return kinds


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word and word beginning, repeats included."""
    n = len(words)
    size = words.stop - words.start
    parts = [(words.doc, words.hash)]
    for k in PREFIXES:
        long = np.flatnonzero(size > k)
        if len(long):
            parts.append((words.doc[long], words.prefix_hash(k)[long] + np.uint64(k)))
    doc = np.concatenate([p[0] for p in parts]) if n else np.zeros(0, dtype=np.int64)
    value = np.concatenate([p[1] for p in parts]) if n else np.zeros(0, dtype=np.uint64)
    return doc, (value >> np.uint64(64 - BITS)).astype(np.int64)


def _distinct(words: Words, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    doc, feature = _features(words)
    if table is not None:
        some = table[feature] != 0
        doc, feature = doc[some], feature[some]
    both = np.unique((doc << BITS) | feature)
    return both >> BITS, both & ((1 << BITS) - 1)


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of the hashed features and the intercept; ``weights`` has 2**BITS entries.

    ``pairs`` counts the texts' counterfactuals, ``change`` is the mean absolute change of log-odds between both, ``kinds`` are the
    kinds of terms that came from the labelled rows.
    """

    weights: np.ndarray
    intercept: float
    rows: int
    pairs: int
    change: float = 0.0
    kinds: tuple[tuple[str, ...], ...] = ()

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, score) of every row of ``docs`` (doc_id, text): between 0 and 1; null and empty texts get the intercept's."""
        shared = docs.sparkSession.sparkContext.broadcast((self.weights, self.intercept))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, intercept = shared.value
            for batch in batches:
                margin = np.full(batch.num_rows, intercept)
                for words in word_chunks(batch.column(1), lower=True, separators=_LETTERS):
                    doc, feature = _distinct(words, weights)
                    margin[words.rows.start: words.rows.stop] += np.bincount(doc, weights[feature], minlength=len(words.rows))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1.0 / (1.0 + np.exp(-np.clip(margin, -40, 40))))], names=["doc_id", "score"])

        return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def _rows(labelled: DataFrame, tables: list[dict[str, str]]) -> DataFrame:
    """(toxic, features, swapped): the distinct features of each text and of its counterfactuals (an empty list without any)."""

    def lists(column: pa.Array) -> list:
        made: list = []
        for words in word_chunks(column, lower=True, separators=_LETTERS):
            doc, feature = _distinct(words)
            made += [x.astype(np.int32) for x in np.split(feature, np.searchsorted(doc, np.arange(1, len(words.rows))))]
        return made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 200):
                part = batch.slice(begin, 200)
                swapped: list[list] = [[] for _ in range(part.num_rows)]
                for table in tables:
                    other = [counterfactual(t, table) for t in part.column(1).to_pylist()]
                    for i, (t, features) in enumerate(zip(other, lists(pa.array(other, pa.string())))):
                        if t is not None:
                            swapped[i].append(features)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lists(part.column(1)), pa.list_(pa.int32())), pa.array(swapped, pa.list_(pa.list_(pa.int32())))],
                    names=["toxic", "features", "swapped"])

    return labelled.select(F.col("toxic").cast("int"), F.col("text").cast("string")).mapInArrow(
        run, "toxic int, features array<int>, swapped array<array<int>>")


def fit(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES, ridge: float = 5e-5,
    fairness: float = 0.5, steps: int = 600,
) -> ToxicityModel:
    """Fit on the texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) covers.

    At most ``max_rows`` rows, those with the least hash of doc_id, and the ``max_features`` features whose frequency differs
    most between both labels (both counted over these rows). The driver holds the kept features of these rows, nothing of the
    corpus. ``fairness`` weighs the squared change of log-odds between a text and its counterfactuals. Without rows of both
    labels the score is constant.
    """
    chosen = (
        labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")  # at most max_rows rows
    texts = texts.select("toxic", F.coalesce("text", F.lit("")).alias("text")).persist()
    kinds = kinds_of_terms(texts)
    rows = _rows(texts, swaps([*IDENTITY, *kinds])).persist()
    n_pos, n = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    n_neg = n - n_pos
    weights = np.zeros(1 << BITS)
    if not n_pos or not n_neg:
        rows.unpersist()
        texts.unpersist()
        return ToxicityModel(weights, float(np.log((n_pos + 0.5) / (n_neg + 0.5))), n, 0)
    counts = rows.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(F.sum("toxic").alias("pos"), F.count("*").alias("all"))
    gap = F.col("pos") / n_pos - (F.col("all") - F.col("pos")) / n_neg
    spread = F.sqrt((F.col("all") + 1.0) / n)
    best = [r[0] for r in counts.where("all >= 3").orderBy(F.desc(F.abs(gap) / spread), "f").limit(max_features).collect()]
    keep = F.lit(best or [-1]).cast("array<int>")
    held = rows.select(
        "toxic", F.array_intersect("features", keep).alias("a"),
        F.transform("swapped", lambda x: F.array_intersect(x, keep)).alias("b")).collect()
    rows.unpersist()
    texts.unpersist()
    place = {f: i for i, f in enumerate(best)}
    x = np.zeros((len(held), len(best)), dtype=np.float32)
    change = []
    for i, r in enumerate(held):
        x[i, [place[f] for f in r.a]] = 1
        for other in r.b:
            d = x[i].copy()
            d[[place[f] for f in other]] -= 1
            change.append(d)
    y = np.array([r.toxic for r in held], dtype=np.float32)
    pairs = np.array(change, dtype=np.float32).reshape(len(change), len(best))
    w, b = np.zeros(len(best)), float(np.log(n_pos / n_neg))
    memory, memory_b = np.full(len(best), 1e-8), 1e-8
    for _ in range(steps):
        miss = 1 / (1 + np.exp(-np.clip(x @ w + b, -40, 40))) - y
        grad = x.T @ miss / len(y) + ridge * w
        if len(pairs):
            grad += 2 * fairness * (pairs.T @ (pairs @ w)) / len(pairs)
        bias = float(miss.mean())
        memory += grad * grad
        memory_b += bias * bias
        w -= 0.5 * grad / np.sqrt(memory)
        b -= 0.1 * bias / np.sqrt(memory_b)
    weights[best] = w
    moved = float(np.abs(pairs @ w).mean()) if len(pairs) else 0.0
    return ToxicityModel(weights, b, n, len(pairs), moved, tuple(map(tuple, kinds)))
