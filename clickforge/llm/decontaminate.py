"""Benchmark decontamination by winnowing, with DataFrame functions only.

Of the k-gram hashes in every window of ``window`` words the least one is kept as a fingerprint. Two texts that share a window
share its fingerprint, so joining the fingerprints of documents and benchmark items misses no shared window. Hits are then
extended: each document window with a shared fingerprint is compared, word by word, with the windows of the items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import BROADCAST_IDS, broadcast_within, keyed, parted, stored

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str | Column) -> Column:
    """The lower-cased words of a text: runs of digits, letters a-z and characters beyond ASCII."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), "")


def _grams(name: str, k: int) -> Column:
    """The hash of each element with the ``k`` - 1 behind it."""
    return F.transform(name, lambda x, i: F.xxhash64(x, *[F.get(name, i + j) for j in range(1, k)]))


def _lower(name: str, step: int) -> Column:
    """The lesser of each element and the one ``step`` behind it."""
    return F.transform(name, lambda x, i: F.least(x, F.get(name, i + step)))


def _with_fingerprints(df: DataFrame, lengths: list[int], gram: int) -> DataFrame:
    """Adds ``prints``: for each length, its windows' least k-gram hashes in the order of the windows.

    Reads ``words``. Each step is a column of its own, so that an array is made once and not for each of its elements. What
    comes of it goes through outer generators only: for plain ones the optimizer pushes a filter on the array's size below
    the steps, where each step runs again for every element of the one before.
    """
    keep = [c for c in df.columns]
    df = df.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    made = []
    for length in lengths:
        k = min(gram, length)
        name = f"low_{length}"
        df = df.withColumn(name, _grams("h", k) if k > 1 else F.col("h"))
        have, want = 1, length - k + 1
        while have < want:
            step = min(have, want - have)
            df = df.withColumn(f"{name}_{have + step}", _lower(name, step))
            have += step
            name = f"{name}_{have}"
        made.append(F.struct(F.lit(length).alias("length"), F.slice(name, 1, F.greatest(F.size("words") - (length - 1), F.lit(0))).alias("low")))
    return df.select(*keep, F.array(*made).alias("prints"))


def item_windows(benchmark: DataFrame, window: int = 10) -> DataFrame:
    """(item_id, length, passage): the windows of each item; an item of fewer words, but not none, is one window."""
    words = benchmark.select(F.col("item_id").cast("long"), words_of(F.col("text").cast("string")).alias("words")).where("size(words) > 0")
    length = F.least(F.size("words"), F.lit(window))
    return words.withColumn("length", length).select(
        "item_id", "length", F.explode_outer(F.transform(
            F.sequence(F.lit(1), F.size("words") - F.col("length") + 1), lambda i: F.array_join(F.slice("words", i, F.col("length")), " "))).alias("passage")
    ).where("passage is not null").distinct()


def hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5) -> DataFrame:
    """(rid, item_id, at, length): every place of ``docs`` (rid, text) at which a window of a benchmark item occurs."""
    passages, _ = stored(item_windows(benchmark, window), "passages")
    lengths = sorted(r[0] for r in passages.select("length").distinct().collect())  # at most ``window`` numbers
    if not lengths:
        return docs.sparkSession.createDataFrame([], "rid long, item_id long, at int, length int")
    parts = passages.select("length", F.split("passage", " ").alias("words"))
    tested = _with_fingerprints(parts, lengths, gram).select("length", F.explode_outer("prints").alias("p")).where("p.length = length").select(
        "length", F.explode_outer("p.low").alias("fp")).where("fp is not null").distinct()
    tested = broadcast_within(tested, BROADCAST_IDS)

    prints = _with_fingerprints(docs.select("rid", words_of("text").alias("words")), lengths, gram)
    posted = prints.select("rid", F.explode_outer("prints").alias("p")).select(
        "rid", F.col("p.length").alias("length"), F.explode_outer(F.array_distinct("p.low")).alias("fp"))
    shared, _ = stored(posted.join(tested, ["length", "fp"], "left_semi").groupBy("rid", "length").agg(F.collect_set("fp").alias("fps")), "shared")

    candidates, _ = parted(docs.dropDuplicates(["rid"]), shared.select("rid").distinct())
    again = _with_fingerprints(candidates.select("rid", words_of("text").alias("words")), lengths, gram).select("rid", "words", F.explode_outer("prints").alias("p"))
    places = again.select("rid", "words", F.col("p.length").alias("length"), F.col("p.low").alias("low")).join(shared, ["rid", "length"]).select(
        "rid", "words", "length", F.explode_outer(F.filter(
            F.transform("low", lambda x, i: F.when(F.array_contains("fps", x), i)), lambda i: i.isNotNull())).alias("at")).where("at is not null")
    extended = places.select("rid", "at", "length", F.array_join(F.slice("words", F.col("at") + 1, F.col("length")), " ").alias("passage"))
    return extended.join(broadcast_within(passages, BROADCAST_IDS // 10), ["length", "passage"]).select("rid", "item_id", "at", "length")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5) -> DataFrame:
    """For every row of ``docs`` (doc_id, text; further columns are ignored): which of its words benchmark items cover.

    Returns doc_id, rid, n_words, n_hit (words inside an occurrence of a window), spans (word spans, from start up to stop, that
    are covered, in order) and items (ids of the items with occurring windows, sorted as strings). Null and empty texts have no
    words; items without words have no window; an empty benchmark hits nothing.
    """
    docs = keyed(docs)
    found, _ = stored(hits(docs, benchmark, window, gram), "hits")
    spans = found.groupBy("rid", "at").agg(F.max("length").alias("length"), F.collect_set(F.col("item_id").cast("string")).alias("items"))
    per_doc = spans.groupBy("rid").agg(
        F.sort_array(F.collect_list(F.struct(F.col("at").alias("start"), (F.col("at") + F.col("length")).alias("stop")))).alias("found"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    point = "struct<start:int,stop:int>"
    # found is sorted by start: a span that begins inside the last one makes it longer
    merged = F.aggregate(
        "found", F.expr(f"cast(array() as array<{point}>)"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["start"] <= F.element_at(acc, -1)["stop"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["stop"], x["stop"]).alias("stop"))))
        ).otherwise(F.concat(acc, F.array(x))))
    per_doc = per_doc.select("rid", "items", merged.alias("spans"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + (x["stop"] - x["start"]))
    counted = docs.select("doc_id", "rid", F.size(words_of("text")).cast("long").alias("n_words"))
    return counted.join(per_doc, "rid", "left").select(
        "doc_id", "rid", "n_words", F.coalesce(hit, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", F.expr(f"cast(array() as array<{point}>)")).alias("spans"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))
