"""MinHash near-duplicates with circulant signatures, banding and exact verification.

Two permutations make the whole signature: sigma scatters a shingle over a ring of ``RING`` places, and coordinate k is
the least value of pi, circularly shifted by k, over the places of the set. Since the shifts of one place are neighbours
in pi, a shingle contributes one contiguous slice of the table.

Sets that are equal collapse to one representative before banding. Buckets never emit all their pairs: every member is
held against the bucket's leader, the member that meets most others over all its buckets, and linked sets are joined to
components. Members of buckets that still have several components are then held against those of other components, as far
as their rarest shingles allow a link at all. Pairs inside one component can change nothing. Every pair that the bands
propose is thus verified on the full sets, already connected, or ruled out by its sizes and rarest shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickforge.llm.common import BROADCAST_IDS, broadcast_within, mix64, ngram_hashes, row_id, stored, word_chunks
from clickforge.llm.components import components

RING = 1 << 20
SEED = 20240229


def _tables(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """sigma, and pi in all its shifts as a view: row p holds pi at p, p + 1, ... around the ring."""
    draw = np.random.default_rng(SEED)
    sigma = draw.permutation(RING).astype(np.int32)
    pi = draw.permutation(RING).astype(np.int32)
    return sigma, np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[: coordinates - 1]]), coordinates)


def _sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """The place of each text in the batch and the sorted hashes of its distinct shingles."""
    for words in word_chunks(column, lower=True):
        at, grams = ngram_hashes(words, size)
        cut = np.searchsorted(at, words.first)
        for i, row in enumerate(words.rows):
            lo, hi = words.first[i], words.first[i + 1]
            if hi - lo >= size:
                yield row, np.unique(grams[cut[i]: cut[i + 1]])
            elif hi > lo:
                whole = np.uint64(hi - lo)
                for h in words.hash[lo:hi]:
                    whole = mix64(np.array([whole], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + h)[0]
                yield row, np.array([whole], dtype=np.uint64)
            else:
                yield row, np.zeros(0, dtype=np.uint64)


def sketches(docs: DataFrame, shingle: int = 5, bands: int = 16, rows: int = 4) -> DataFrame:
    """(doc_id, rid, n_shingles, a, b, bands) of rows (doc_id, rid, text): set size, 128 bits for the whole set, and one value for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigma, shifted = _tables(bands * rows)
        scale = mix64(np.arange(1, bands * rows + 1, dtype=np.uint64)).reshape(bands, rows)
        for batch in batches:
            size = np.zeros(batch.num_rows, dtype=np.int64)
            a, b = (np.zeros(batch.num_rows, dtype=np.uint64) for _ in range(2))
            keys = np.zeros((batch.num_rows, bands), dtype=np.uint64)
            for row, grams in _sets(batch.column(2), shingle):
                size[row] = len(grams)
                if len(grams):
                    a[row] = np.add.reduce(grams)
                    b[row] = np.add.reduce(mix64(grams ^ np.uint64(0x5851F42D4C957F2D)))
                    low = np.full(bands * rows, RING, dtype=np.int32)
                    place = sigma[(grams >> np.uint64(44)).astype(np.int64)]
                    for i in range(0, len(place), 4096):
                        np.minimum(low, shifted[place[i: i + 4096]].min(axis=0), out=low)
                    keys[row] = mix64((low.astype(np.uint64).reshape(bands, rows) + np.uint64(1)) * scale).sum(axis=1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(size), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).ravel()), bands).cast(pa.list_(pa.int64())),
            ], names=["doc_id", "rid", "n_shingles", "a", "b", "bands"])

    return docs.select("doc_id", "rid", "text").mapInArrow(run, "doc_id long, rid long, n_shingles long, a long, b long, bands array<long>")


def shingle_sets(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """(rid, shingles) of rows (rid, text): the hashes of each text's distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held, total = [], [], 0
            for row, grams in _sets(batch.column(1), shingle):
                ids.append(row)
                held.append(grams.view(np.int64))
                total += len(grams)
                if total > 1 << 20:
                    yield _lists(batch, ids, held)
                    ids, held, total = [], [], 0
            yield _lists(batch, ids, held)

    return docs.select("rid", "text").mapInArrow(run, "rid long, shingles array<long>")


def _lists(batch: pa.RecordBatch, ids: list[int], held: list[np.ndarray]) -> pa.RecordBatch:
    ends = np.cumsum([0, *map(len, held)]).astype(np.int32)
    flat = pa.array(np.concatenate(held) if held else np.zeros(0, dtype=np.int64))
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(pa.array(ids, pa.int64())), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["rid", "shingles"])


def near_duplicates(docs: DataFrame, percent: int = 85, shingle: int = 5, bands: int = 16, rows: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, rid, part) of every row of ``docs`` (doc_id, text; further columns are ignored).

    Texts whose sets of ``shingle``-word shingles (A-Z lower-cased; fewer words: all of them as one) have
    ``100 * intersection >= percent * union`` are linked. ``component_id`` is the smallest doc_id that links reach; rows
    with it are kept. Null, empty and blank texts have no shingles and no links. Rows that repeat a doc_id are documents of their
    own, told apart by ``rid`` (``row_id``: equal rows are one); ``part`` names the rows that links reach (null without
    shingles). A row without doc_id is kept if it reaches no id. A pair at the threshold of 85 misses all 16 bands of 4 with a
    probability of about 1e-5.
    """
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_id().alias("rid"), F.col("text").cast("string").alias("text"))
    known, _ = stored(sketches(marked, shingle, bands, rows), "sketches")
    full = known.where("n_shingles > 0")
    reps, _ = stored(
        full.groupBy("a", "b", "n_shingles").agg(F.min("rid").alias("rep"), F.min("doc_id").alias("least"), F.first("bands").alias("bands"))
        .select("rep", "least", "n_shingles", "a", "b", "bands"), "representatives")
    posted = reps.select("rep", F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "key"))
    crowd = posted.groupBy("band", "key").agg(F.count("*").alias("members")).where("members > 1")
    shared, _ = stored(posted.join(crowd, ["band", "key"]), "buckets")
    reach = shared.groupBy("rep").agg(F.sum("members").alias("reach"))
    hubs = shared.join(reach, "rep").groupBy("band", "key").agg(
        F.max(F.struct("reach", (-F.col("rep")).alias("first"), "rep", "n")).alias("leader"))
    bucketed, _ = stored(shared.drop("members").join(hubs, ["band", "key"]).select(
        "band", "key", "rep", "n", F.struct("leader.rep", "leader.n").alias("leader")), "led")

    close = f"100 * least(n, m) >= {int(percent)} * greatest(n, m)"
    star = (
        bucketed.select(F.col("leader.rep").alias("i"), F.col("leader.n").alias("n"), F.col("rep").alias("j"), F.col("n").alias("m"))
        .where("i <> j").where(close).distinct()
    )
    needed = bucketed.select(F.col("rep").alias("rid")).distinct()
    chosen = marked.join(broadcast_within(needed, BROADCAST_IDS), "rid", "left_semi")
    sets, _ = stored(shingle_sets(chosen, shingle).dropDuplicates(["rid"]), "shingles")  # equal rows have equal sets

    first, _ = stored(_verified(star, sets, percent), "links")
    groups = components(first)
    state = bucketed.join(groups.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    state, _ = stored(state.select("band", "key", "rep", "n", "component", F.col("leader.rep").alias("leader")), "state")
    split = state.groupBy("band", "key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
    rest, _ = stored(
        state.join(split.select("band", "key"), ["band", "key"]).where("rep <> leader").select("rep", "n", "component").distinct(), "open")
    cross = _candidates(rest, sets, percent)
    second, _ = stored(_verified(cross, sets, percent), "links")
    final = components(groups.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(second))
    parts, _ = stored(
        reps.join(final.withColumnRenamed("node", "rep"), "rep", "left").select("a", "b", "n_shingles", "least", F.coalesce("component", "rep").alias("part")), "parts")
    lowest = parts.groupBy("part").agg(F.min("least").alias("component_id"))
    named = parts.drop("least").join(lowest, "part")
    linked = known.select("doc_id", "rid", "n_shingles", "a", "b").join(named, ["a", "b", "n_shingles"], "left")
    component = F.when(F.col("part").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return linked.select("doc_id", "n_shingles", component.alias("component_id"), "rid", "part").select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "rid", "part")


def _candidates(open_sets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (i, j, n, m) of ``open_sets`` (rep, n, component) from different components that may be as similar as asked.

    Shingles are ordered by rarity. Two similar sets share a shingle among the first ``n - ceil(percent * n / 100) + 1`` of each, and
    from their first common one on, both still have as many as the intersection needs; pairs without such a shingle are ruled out
    unseen. Among the sets with one shingle, only those outside its largest component are held against the others.
    """
    each = sets.join(open_sets.withColumnRenamed("rep", "rid"), "rid").select("rid", "n", "component", F.explode_outer("shingles").alias("g"))
    common = each.groupBy("g").agg(F.count("*").alias("df"))
    rarest = Window.partitionBy("rid").orderBy("df", "g")
    placed = each.join(common, "g").withColumn("left", F.col("n") - F.row_number().over(rarest) + 1)
    prefix, _ = stored(placed.where(f"df > 1 and 100 * left >= {int(percent)} * n").select("g", "rid", "n", "component", "left"), "prefixes")
    sizes = prefix.groupBy("g", "component").count()
    top = sizes.groupBy("g").agg(F.max(F.struct("count", F.col("component").alias("main"))).alias("top"), F.count("*").alias("parts"))
    met, _ = stored(prefix.join(top.where("parts > 1").select("g", F.col("top.main").alias("main")), "g"), "met")
    minor = met.where("component <> main").select("g", F.col("rid").alias("i"), "n", F.col("component").alias("ci"), F.col("left").alias("li"))
    other = met.select("g", F.col("rid").alias("j"), F.col("n").alias("m"), F.col("component").alias("cj"), F.col("left").alias("lj"), "main")
    enough = f"{100 + int(percent)} * least(li, lj) >= {int(percent)} * (n + m)"
    return (
        minor.join(other, "g").where("ci <> cj and (cj = main or i < j)").where(enough)
        .select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "n", "m").dropDuplicates(["i", "j"])
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (i, j) whose full sets are as similar as asked, as (u, v)."""
    left = sets.select(F.col("rid").alias("i"), F.col("shingles").alias("x"))
    right = sets.select(F.col("rid").alias("j"), F.col("shingles").alias("y"))
    both = pairs.select("i", "j").join(right, "j").join(left, "i").select(
        "i", "j", F.size(F.array_intersect("x", "y")).cast("long").alias("inter"), (F.size("x") + F.size("y")).cast("long").alias("both"))
    return both.where(f"100 * inter >= {int(percent)} * (both - inter)").select(F.col("i").alias("u"), F.col("j").alias("v"))
