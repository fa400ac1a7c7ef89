"""Byte-level BPE: ranked merges as a fold over byte arrays of distinct words, and decoding by concatenation.

Distinct pieces of the corpus are counted in Spark; the most frequent, up to a fixed number and length, are folded with ``aggregate`` and
``transform`` over a literal rank map (an array of small maps, so that a lookup reads one of them; bytes are written in hex there) and
travel to the tasks as a table of bounded size. A task takes a piece's ids from that table, and merges the rest, which by the cap are
the rare ones: many short ones together, a pair in each at a time, on numpy arrays, and long ones with a heap. All follow the same
rule, so the cap bounds memory and time and changes no result. Decoding takes the tokens of all ids of many texts from one array of
tokens, where they come to stand end to end, and cuts the bytes at the texts' ends.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.llm.common import drop_scratch, stored

SLOTS = 1 << 12
#: The table of folded pieces: at most so many pieces, none longer than so many bytes.
TABLE_PIECES = 16_384
FOLD_BYTES = 16
#: Pieces a task remembers beside that table.
CACHE_PIECES = 100_000
#: Pieces a task counts before it sends them on.
COUNTED_PIECES = 100_000
#: Pieces of at most so many bytes are merged together, so many at once; longer ones one by one with a heap.
SHORT = 64
STEP_PIECES = 2_048
#: More than any rank.
NO_PAIR = 1 << 40
#: Texts are taken together until they have so many characters.
CHUNK_CHARS = 1 << 18


def load_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a token in base 64 and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: of all neighbours, those whose joint bytes have the least rank merge first, leftmost first."""
    if piece in ranks:
        return [ranks[piece]]
    parts: list[bytes | None] = [piece[i: i + 1] for i in range(len(piece))]
    before, after = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
    heap = [(r, i, parts[i] + parts[i + 1]) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, joint = heapq.heappop(heap)
        j = after[i]
        if parts[i] is None or j >= len(parts) or parts[i] + parts[j] != joint:
            continue
        parts[i], parts[j] = joint, None
        after[i] = after[j]
        if after[i] < len(parts):
            before[after[i]] = i
            if (r := ranks.get(joint + parts[after[i]])) is not None:
                heapq.heappush(heap, (r, i, joint + parts[after[i]]))
        if before[i] >= 0 and (r := ranks.get(parts[before[i]] + joint)) is not None:
            heapq.heappush(heap, (r, before[i], parts[before[i]] + joint))
    return [ranks[p] for p in parts if p is not None]


class PairTable:
    """The rank of every two neighbouring tokens whose joint bytes are a token, as an open hash table in numpy arrays.

    It has one entry for each way to cut a token in two tokens, so its size is bounded by the vocabulary's bytes.
    """

    def __init__(self, ranks: dict[bytes, int]):
        cuts = [(a << 32 | b, r) for t, r in ranks.items() for i in range(1, len(t))
                if (a := ranks.get(t[:i])) is not None and (b := ranks.get(t[i:])) is not None]
        key, value = np.array(cuts, dtype=np.int64).reshape(-1, 2).T
        bits = max(len(cuts) * 4, 2).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, NO_PAIR, dtype=np.int64)
        left, slot = np.arange(len(key)), self._slots(key)
        while len(left):
            free = left[self.keys[slot[left]] == -1]
            self.keys[slot[free]] = key[free]  # of several, the last one stays; the others look on
            self.values[slot[free]] = value[free]
            left = left[self.keys[slot[left]] != key[left]]
            slot[left] = (slot[left] + 1) & self.mask
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of the pairs; ``NO_PAIR`` for those that do not merge, also where either side is missing (-1)."""
        key = np.where((a < 0) | (b < 0), -2, a << 32 | b)
        slot = self._slots(key)
        seen = self.keys[slot]
        out = np.where(seen == key, self.values[slot], NO_PAIR)
        left = np.flatnonzero((seen != key) & (seen != -1))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            seen = self.keys[slot[left]]
            same = seen == key[left]
            out[left[same]] = self.values[slot[left[same]]]
            left = left[~same & (seen != -1)]
        return out


def merge_many(pieces: list[bytes], pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """``merge`` of many pieces of at most ``SHORT`` bytes that are no token, in rising length: all ids, and how many each piece has.

    One step merges one pair in each piece of a block.
    """
    blocks = [_merge_block(pieces[i: i + STEP_PIECES], pairs) for i in range(0, len(pieces), STEP_PIECES)]
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *[ids for ids, _ in blocks]]), np.concatenate([none, *[size for _, size in blocks]])


def _merge_block(pieces: list[bytes], pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Columns are pieces, rows places, with a row for the border on either side; joined tokens stay at the left place."""
    size = np.array([len(p) for p in pieces])
    high, wide = int(size.max()), len(pieces)
    inside = np.arange(high)[None, :] < size[:, None]
    token = np.full((wide, high + 2), -1, dtype=np.int64)
    token[:, 1:-1][inside] = pairs.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    token = np.ascontiguousarray(token.T)
    row = np.arange(high + 2, dtype=np.int64)[:, None]
    after, before = np.repeat(row + 1, wide, axis=1), np.repeat(row - 1, wide, axis=1)
    # A pair's rank and place in one number: the least is the leftmost of the least rank.
    cost = np.full((high + 2, wide), NO_PAIR << 8, dtype=np.int64)
    cost[1:-1] = pairs.look(token[1:-1].ravel(), token[2:].ravel()).reshape(high, wide) << 8 | row[1:-1]
    live, who = token, np.arange(wide)  # the columns still at work, and which they are
    while True:
        low = cost.min(axis=0)
        busy = np.flatnonzero(low < NO_PAIR << 8)
        if 2 * len(busy) < len(low):
            if live is not token:
                token[:, who] = live
            if not len(busy):
                break
            live, who, low = live[:, busy], who[busy], low[busy]
            cost, after, before = cost[:, busy], after[:, busy], before[:, busy]
            busy = np.arange(len(who))
        else:
            low = low[busy]
        at, rank = low & 255, low >> 8
        gone = after[at, busy]
        right, left = after[gone, busy], before[at, busy]
        live[at, busy], live[gone, busy] = rank, -1
        after[at, busy], before[right, busy] = right, at
        cost[gone, busy] = NO_PAIR << 8
        cost[at, busy] = pairs.look(rank, live[right, busy]) << 8 | at
        cost[left, busy] = pairs.look(live[left, busy], rank) << 8 | left
    held = token.T >= 0
    return token.T[held], held.sum(axis=1)


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The rank map as a literal that the optimizer folds once: ``SLOTS`` maps from token (hex) to rank.

    A token's slot is its crc32 modulo ``SLOTS``, so that a lookup scans one small map. It is as large as the vocabulary.
    """
    slots: list[dict[str, int]] = [{} for _ in range(SLOTS)]
    for token, rank in ranks.items():
        key = token.hex().upper()
        slots[zlib.crc32(key.encode()) % SLOTS][key] = rank
    return F.from_json(F.lit(json.dumps(slots, separators=(",", ":"))), "array<map<string,int>>")


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def folded(piece: str, slots: Column) -> Column:
    """The ids of a piece (its bytes as hex): as many merge steps as it has neighbours, each joining the least-ranked pair."""
    return _let(slots, lambda bound: _folded(F.col(piece), bound))


def _folded(piece: Column, slots: Column) -> Column:
    none = F.lit(1 << 30)

    def rank(token: Column) -> Column:
        return F.try_element_at(F.get(slots, (F.crc32(token) % SLOTS).cast("int")), token)

    def joined(parts: Column, ranks: Column) -> Column:
        return _let(F.array_min(ranks), lambda low: F.when(low == none, parts).otherwise(_let(
            F.array_position(ranks, low).cast("int"), lambda p: F.concat(
                F.slice(parts, 1, p - 1), F.array(F.concat(F.element_at(parts, p), F.element_at(parts, p + 1))),
                F.slice(parts, p + 2, F.size(parts))))))

    def step(parts: Column) -> Column:
        ranks = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda x, i: F.coalesce(rank(F.concat(x, F.get(parts, i + 1))), none))
        return _let(ranks, lambda r: joined(parts, r))

    def after(acc: Column) -> Column:
        return _let(step(acc["parts"]), lambda p: F.struct(p.alias("parts"), (F.size(p) == F.size(acc["parts"])).alias("done")))

    size = (F.length(piece) / 2).cast("int")
    single = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.substring(piece, (2 * i + 1).cast("int"), F.lit(2)))
    fold = F.aggregate(
        F.sequence(F.lit(1), size), F.struct(single.alias("parts"), F.lit(False).alias("done")),
        lambda acc, _: F.when(acc["done"] | (F.size(acc["parts"]) < 2), F.struct(acc["parts"].alias("parts"), F.lit(True).alias("done"))).otherwise(after(acc)))
    return _let(rank(piece), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(fold["parts"], rank)))


def frequent_pieces(docs: DataFrame, pattern: str, at_most: int = TABLE_PIECES) -> tuple[DataFrame, str]:
    """(piece, n), stored, and where: the corpus' most frequent pieces that are short enough to fold, counted over all texts.

    How many pieces are how frequent is added up by classes of frequency, and the classes from the top on that fit
    into ``at_most`` are taken whole, so nothing sorts the pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern).findall
        seen: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([k.encode() for k in seen], pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["piece", "n"])
            seen.clear()
            return made

        for batch in batches:
            for text in batch.column(0):
                if (t := text.as_py()):
                    seen.update(split(t))
                if len(seen) > COUNTED_PIECES:
                    yield out()
        yield out()

    spark = docs.sparkSession
    counts = docs.select(F.col("text").cast("string")).mapInArrow(run, "piece binary, n long").where(F.length("piece") <= FOLD_BYTES)
    counted, path = stored(counts.groupBy("piece").agg(F.sum("n").alias("n")).where("n > 1").withColumn("kind", F.floor(F.log2("n") * 16).cast("int")), "counts")
    least, total = None, 0
    for r in counted.groupBy("kind").count().orderBy(F.desc("kind")).collect():  # at most 16 classes for each bit of a count
        total += r["count"]
        if total > at_most:
            break
        least = r.kind
    found = stored(counted.where(F.col("kind") >= F.lit(least)).select("piece", "n"), "pieces")
    drop_scratch(spark, path)
    return found


def folded_table(docs: DataFrame, ranks: dict[bytes, int], pattern: str, at_most: int = TABLE_PIECES) -> dict[bytes, list[int]]:
    """The ids of the frequent pieces by the fold; at most ``at_most`` entries of at most ``FOLD_BYTES`` bytes each.

    The literal rank map holds the tokens that are part of such a piece: the fold can ask for no others, and plans stay small.
    """
    spark = docs.sparkSession
    pieces, path = frequent_pieces(docs, pattern, at_most)
    found = [bytes(r[0]) for r in pieces.select("piece").collect()]  # bounded by at_most
    parts = {p[i:j] for p in found for i in range(len(p)) for j in range(i + 1, len(p) + 1)}
    literal = rank_literal({t: ranks[t] for t in parts & ranks.keys()})
    spread = pieces.repartition(max(8, spark.sparkContext.defaultParallelism * 2), "piece").withColumn("code", F.hex("piece"))
    table = {bytes(r[0]): list(r[1]) for r in spread.select("piece", folded("code", literal).alias("ids")).collect()}
    drop_scratch(spark, path)
    return table


class _Known:
    """The ids of the pieces a task has met: a piece has a number, and its ids stand together in one array."""

    def __init__(self, table: dict[bytes, list[int]], ranks: dict[bytes, int], pairs: PairTable):
        self.ranks, self.pairs = ranks, pairs
        self.table = {k.decode("utf-8", "surrogateescape"): i for i, k in enumerate(table)}
        self.ids = np.fromiter(chain.from_iterable(table.values()), dtype=np.int32)
        self.ends = np.concatenate([[0], np.cumsum([len(x) for x in table.values()], dtype=np.int64)])
        self.head = len(self.ids)
        self.number = dict(self.table)

    def learn(self, pieces: set[str]) -> None:
        """Give the pieces numbers and ids."""
        if len(self.number) > CACHE_PIECES + len(self.table):  # forget all but the table
            self.number, self.ids, self.ends = dict(self.table), self.ids[: self.head], self.ends[: len(self.table) + 1]
        single, short, long = [], [], []
        for piece in pieces.difference(self.number):
            code = piece.encode()
            rank = self.ranks.get(code)
            if rank is not None:
                single.append((piece, rank))
            else:
                (short if len(code) <= SHORT else long).append((code, piece))
        short.sort(key=lambda x: len(x[0]))
        merged, size = merge_many([c for c, _ in short], self.pairs)
        heaped = [merge(c, self.ranks) for c, _ in long]
        names = [*[p for p, _ in single], *[p for _, p in short], *[p for _, p in long]]
        self.number.update(zip(names, range(len(self.ends) - 1, len(self.ends) - 1 + len(names))))
        sizes = np.concatenate([np.ones(len(single), dtype=np.int64), size, np.array([len(x) for x in heaped], dtype=np.int64)])
        self.ids = np.concatenate([self.ids, np.array([r for _, r in single], dtype=np.int32), merged.astype(np.int32), np.fromiter(chain.from_iterable(heaped), dtype=np.int32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def of(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts' pieces in one array, and where each text ends in it."""
        self.learn(set().union(*texts))
        number = np.fromiter(map(self.number.__getitem__, chain.from_iterable(texts)), dtype=np.int64)
        size = self.ends[number + 1] - self.ends[number]
        until = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(int(until[-1])) + np.repeat(self.ends[number] - until[:-1], size)
        return self.ids[at], until[np.cumsum([len(x) for x in texts])]


class _Tokens:
    """The tokens by id, for decoding."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.large_binary())

    def joined(self, ids: pa.Array, ends: np.ndarray) -> pa.Array:
        """The bytes of each text: its ids reach from the end before, or 0, to its own in ``ends``."""
        try:
            taken = self.tokens.take(ids)
        except pa.ArrowIndexError as e:
            raise ValueError("an id has no token") from e
        if taken.null_count:
            raise ValueError("an id has no token")
        _, offsets, data = taken.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[np.concatenate([[0], ends])] if len(taken) else np.zeros(len(ends) + 1, dtype=np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(at), data]).cast(pa.binary())


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, at_most: int = TABLE_PIECES, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text; further columns are ignored): the whole text's token ids.

    Each match of ``pattern`` is merged for itself; there are no special tokens. Null counts as empty and has no ids. With ``decoded``
    a column of that name has the bytes that the ids decode to, as ``decode`` gives them, in the same pass.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, folded_table(docs, ranks, pattern, at_most)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, table = shared.value
        known, tokens = _Known(table, ranks, PairTable(ranks)), _Tokens(ranks)
        split = regex.compile(pattern).findall
        for batch in batches:
            done, texts, size = 0, [], 0
            for row, text in enumerate(batch.column(1)):
                value = text.as_py() or ""
                texts.append(split(value))
                size += len(value)
                if size > CHUNK_CHARS or row + 1 == batch.num_rows:
                    flat, ends = known.of(texts)
                    ids = pa.array(flat)
                    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                    made = {"doc_id": batch.column(0).slice(done, len(texts)), "ids": pa.ListArray.from_arrays(offsets, ids)}
                    if decoded:
                        made["decoded"] = tokens.joined(ids, ends)
                    yield pa.RecordBatch.from_pydict(made)
                    done, texts, size = row + 1, [], 0

    schema = "doc_id long, ids array<int>" + (", decoded binary" if decoded else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` (ids, any other columns) with ``decoded`` (binary): the tokens' bytes, concatenated. Null ids give none; an id without a token is an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens(shared.value)
        for batch in batches:
            lists = batch.column(names.index("ids"))
            ends = np.cumsum([len(x) if x.is_valid else 0 for x in lists], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, tokens.joined(lists.flatten(), ends)], names=[*names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, schema + ", decoded binary")
