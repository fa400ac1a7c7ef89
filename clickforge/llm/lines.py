"""Line dedup: a suffix array over line ids by prefix doubling, with DataFrame functions only.

The corpus is read as one sequence of line ids per document; only lines with a word count. A line that occurs once is no part of any
copy, so the array holds the suffixes that begin with a repeated line. Doubling names them by their first 1, 2, 4, ... lines: the pair
of a suffix's name and the name of the suffix that far behind gets a new name, whose order is that of the pairs. Names come from
sorting the distinct pairs by range over all partitions, so equal prefixes have one name and names sort as suffixes do. A suffix is
settled when no other has its prefix or the prefix passes the document's end; it keeps its place, and the rounds end when all are settled.

The suffix array is the order of the last names. The longest common prefix of two neighbours is added up from the kept rounds, the
longest first: where both have the same 2^k lines behind what they share so far, they share these too. Two neighbours enter at the last
round in which both were open, as they share no longer prefix; most copies are of one line and need no round. Neighbours that share enough
lines form the intervals; in each, the first copy stays, and the windows of all others merge to the maximal runs that are deleted.
A copy is ``min_lines`` long; with ``min_words``, 1, 2, ... lines with that many words are one too, and each of these lengths has intervals of
its own. Longer copies need none: each of their lines but the last begins a shorter copy, and the windows of these cover them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickforge.llm.common import drop_scratch, keyed, parted, stored

PLACE = ["doc_id", "rid", "seq"]
#: ``monotonically_increasing_id`` has the partition above these bits.
PART_BITS = 33


def _numbered(text: str) -> Column:
    """The lines of a text that have a word, each with its number."""
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("pos"), x.alias("line")))
    return F.filter(lines, lambda s: s["line"].rlike(r"[^\x20\x09-\x0D]"))


def _sorted(rows: DataFrame, keys: list[str], at: str) -> DataFrame:
    """``rows`` by range of ``keys`` over all partitions, numbered by ``at`` in that order."""
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(at, F.monotonically_increasing_id())


def _lengths(min_lines: int, min_words: int | None) -> list[int]:
    """The numbers of lines that can make a copy."""
    return [min_lines] if min_words is None else list(range(1, min_lines + 1))


def _repeated_lines(docs: DataFrame, min_lines: int, min_words: int | None) -> tuple[DataFrame, str]:
    """(doc_id, rid, seq, pos, name, ends) of the lines that occur twice or more, as a written table and its path.

    ``ends``: for each length of a copy the number of its last line, null where too few lines or words follow. Where a line in between
    is not repeated, no copy reaches over it and the length does not matter.
    """
    spark = docs.sparkSession
    words = F.lit(0) if min_words is None else F.regexp_count("s.line", F.lit(r"[^\x20\x09-\x0D]+"))
    lines = docs.select("doc_id", "rid", F.posexplode_outer(_numbered("text")).alias("seq", "s")).where("s is not null").select(
        *PLACE, F.col("s.pos").alias("pos"), words.alias("words"), F.unhex(F.md5("s.line")).alias("line"))
    names, written = stored(_sorted(lines.groupBy("line").count().where("count > 1").select("line"), ["line"], "name"), "names")
    rows = lines.join(names, "line").drop("line").dropDuplicates(["rid", "seq"])  # rows that repeat a document are one
    order = Window.partitionBy("rid").orderBy("seq")
    ends = []
    for n in _lengths(min_lines, min_words):
        until = F.first("pos").over(order.rangeBetween(n - 1, n - 1))
        ends.append(until if n == min_lines else F.when(F.sum("words").over(order.rangeBetween(0, n - 1)) >= min_words, until))
    out = stored(rows.withColumn("ends", F.array(*ends)).select(*PLACE, "pos", "name", "ends"), "lines")
    drop_scratch(spark, written)
    return out


def _rounds(lines: DataFrame) -> tuple[list[DataFrame], DataFrame, list[str]]:
    """Prefix doubling over ``lines``: (rid, seq, name) of the suffixes whose first 1, 2, 4, ... lines are repeated; last, all names; the paths.

    All names come with ``top``: the place of the last of the former tables that has the suffix.
    """
    now = lines.select("rid", "seq", "name", F.lit(True).alias("open"), F.lit(0).alias("top"))
    levels, paths, have, going = [], [], 1, not lines.isEmpty()
    while going:
        levels.append(now.where("open").drop("open", "top"))
        behind = Window.partitionBy("rid").orderBy("seq").rangeBetween(have, have)
        pairs = now.withColumn("next", F.first(F.struct("name", "open")).over(behind)).select(
            "rid", "seq", F.col("name").alias("a"), F.when(F.col("open"), F.coalesce("next.name", F.lit(-1))).otherwise(-1).alias("b"),
            (F.col("open") & F.coalesce("next.open", F.lit(False))).alias("open"), "top")
        names = _sorted(pairs.groupBy("a", "b").count().select("a", "b", (F.col("count") > 1).alias("again")), ["a", "b"], "name")
        still = F.col("open") & F.col("again")
        named = pairs.join(names, ["a", "b"]).select("rid", "seq", "name", still.alias("open"), F.when(still, len(levels)).otherwise(F.col("top")).alias("top"))
        now, path = stored(named, "suffixes")
        going = not now.where("open").isEmpty()  # not observed by the write: with an observation in its session no MLlib model can be sent to tasks
        paths.append(path)
        have *= 2
    return levels, now.drop("open"), paths


def _before(rows: DataFrame, carried: dict[str, Column]) -> DataFrame:
    """For each partition (part) of the array the greatest value of each of ``carried`` in the partitions before it: one row a partition."""
    ends = rows.groupBy("part").agg(*[F.max(value).alias(name) for name, value in carried.items()])
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(ends.select("part", *[F.max(name).over(order).alias(name) for name in carried]))


def suffix_array(docs: DataFrame, min_lines: int = 3, min_words: int | None = None) -> tuple[DataFrame, str]:
    """The suffixes of ``docs`` (doc_id, rid, text) that begin with a repeated line, in order, as a written table and its path.

    Columns: doc_id, rid, ``seq`` and ``pos`` (the line's number among lines with a word, and among all), ``at`` (increasing in the order of
    the array; the partition above its lowest 33 bits), ``lcp`` (lines shared with the suffix before it; 0 for the first) and ``ends`` (for
    each length of a copy its last line's ``pos``, null if there is no such copy here). Suffixes with all the same lines up to their
    ends stand by doc_id (null first), rid and seq.
    """
    spark = docs.sparkSession
    lines, base = _repeated_lines(docs, min_lines, min_words)
    levels, last, paths = _rounds(lines)
    first = lines.withColumnRenamed("name", "line")
    array, path = stored(_sorted(first.join(last, ["rid", "seq"]), ["name", *PLACE], "at").drop("name"), "array")
    parts = array.withColumn("part", F.shiftright("at", PART_BITS))
    this = F.struct("at", "line", "rid", "seq", "top")
    inside = F.lag(this).over(Window.partitionBy("part").orderBy("at"))
    pairs, met = stored(parts.withColumn("inside", inside).join(_before(parts, {"outside": this}), "part").withColumn("p", F.coalesce("inside", "outside")).where(
        "p.line = line").select("at", "rid", "seq", F.col("p.rid").alias("rid2"), F.col("p.seq").alias("seq2"), F.least("top", "p.top").alias("top")), "pairs")
    shared, steps = _shared_lines(pairs, levels)
    out = stored(array.drop("line", "top").join(shared, "at", "left").fillna(0, ["lcp"]), "lcp")
    for done in (base, path, met, *paths, *steps):
        drop_scratch(spark, done)
    return out


def _shared_lines(pairs: DataFrame, levels: list[DataFrame]) -> tuple[DataFrame, list[str]]:
    """(at, lcp) of ``pairs`` of suffixes with the same first line, and the paths of what it is read from.

    Each round is written: one plan of all would hold two joins a round, and every stage that ends has it planned again.
    """
    done, paths = pairs.where("top = 0").select("at", F.lit(1).alias("lcp")), []
    going = None
    for k in reversed(range(len(levels))):
        # At 0 nothing enters: two lines are not shared, and the first one is.
        now = pairs.where(F.col("top") == k).withColumn("lcp", F.lit(0)) if k else None
        now = now if going is None or now is None else going.unionByName(now)
        now = going if now is None else now
        if now is None:
            break
        here = levels[k].select("rid", F.col("seq").alias("x"), F.col("name").alias("one"))
        there = levels[k].select(F.col("rid").alias("rid2"), F.col("seq").alias("y"), F.col("name").alias("two"))
        step = now.withColumns({"x": F.col("seq") + F.col("lcp"), "y": F.col("seq2") + F.col("lcp")}).join(here, ["rid", "x"], "left").join(
            there, ["rid2", "y"], "left").select("at", "rid", "seq", "rid2", "seq2", "top", (F.col("lcp") + F.when(F.col("one") == F.col("two"), 1 << k).otherwise(0)).alias("lcp"))
        going, path = stored(step, "shared")
        paths.append(path)
    return done if going is None else done.unionByName(going.select("at", "lcp")), paths


def suffix_intervals(array: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, rid, seq, pos, until, lines, interval): the suffixes of an array in its intervals, for each length of a copy (``lines``).

    An interval goes on where a suffix shares that many lines with the one before; its number is the place of its first suffix.
    """
    opens = {f"open{n}": F.when(F.col("lcp") < n, F.col("at")) for n in lengths}
    parts = array.withColumn("part", F.shiftright("at", PART_BITS)).withColumns(opens)
    order = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    inside = parts.withColumns({f"in{n}": F.max(f"open{n}").over(order) for n in lengths}).join(
        _before(parts, {f"out{n}": F.col(f"open{n}") for n in lengths}), "part")
    found = F.array(*[F.struct(F.lit(n).alias("lines"), F.col("ends")[i].alias("until"), F.coalesce(f"in{n}", f"out{n}").alias("interval"))
                      for i, n in enumerate(lengths)])
    return inside.select(*PLACE, "pos", F.inline_outer(found)).where("until is not null")


def repeated_runs(docs: DataFrame, min_lines: int = 3, min_words: int | None = None) -> DataFrame:
    """(doc_id, rid, runs): the line runs (from start up to stop, by line number) that an earlier place of the corpus has."""
    spark = docs.sparkSession
    array, path = suffix_array(docs, min_lines, min_words)
    rows, _ = stored(suffix_intervals(array, _lengths(min_lines, min_words)), "intervals")
    drop_scratch(spark, path)
    least = rows.groupBy("lines", "interval").agg(F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first, _ = stored(least, "first")  # apart, so that hot intervals can be split
    windows = rows.join(first, ["lines", "interval"]).where(F.struct(*PLACE) > F.col("first"))
    order = Window.partitionBy("doc_id", "rid").orderBy("pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)  # a longer window may end behind the one before
    later = windows.groupBy("doc_id", "rid", "pos").agg(F.max("until").alias("until"))
    runs = later.withColumn("opens", F.coalesce(F.col("pos") > F.max("until").over(before), F.lit(True)).cast("int")).withColumn(
        "run", F.sum("opens").over(order)).groupBy("doc_id", "rid", "run").agg(F.min("pos").alias("start"), (F.max("until") + 1).alias("stop"))
    return runs.groupBy("doc_id", "rid").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("runs"))


def without_runs() -> Column:
    """``text`` without the lines in ``runs``."""
    stay = F.filter(F.split("text", "\n"), lambda x, i: ~F.exists("runs", lambda r: (i >= r["start"]) & (i < r["stop"])))
    return F.array_join(stay, "\n")


def drop_repeated_lines(docs: DataFrame, min_lines: int = 3, min_words: int | None = None) -> DataFrame:
    """Every row of ``docs`` (doc_id, text; further columns are ignored) without later copies of repeated line runs.

    Returns doc_id, rid, n_lines, n_removed, runs and text. Lines end at a line feed; lines without a word count as lines but are
    no part of a run's ``min_lines``, and go if they lie inside a deleted run. A run is deleted if the same ``min_lines`` or more
    lines begin earlier, in a smaller doc_id or further up in the same text, also where both overlap; null ids come first. With ``min_words``
    a run of fewer lines, also of one, is deleted likewise if it has that many words (without ASCII white space); shorter ones stay.
    Lines are equal if their 128-bit digests are. Null and empty texts have no lines and stay as they are (null as empty). Rows
    equal in id and text count as one document and lose the same lines.
    """
    if min_lines < 1:
        raise ValueError("min_lines must be at least 1")
    if min_words is not None and min_words < 1:
        raise ValueError("min_words must be at least 1")
    docs = keyed(docs)
    runs, _ = stored(repeated_runs(docs, min_lines, min_words), "runs")
    touched, plain = parted(docs, runs.select("rid"))
    lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines")
    none = F.expr("cast(array() as array<struct<start:int,stop:int>>)")
    gone = F.aggregate("runs", F.lit(0).cast("long"), lambda acc, r: acc + (r["stop"] - r["start"])).alias("n_removed")
    cut = touched.join(runs.select("rid", "runs"), "rid").select("doc_id", "rid", lines, gone, "runs", without_runs().alias("text"))
    return plain.select("doc_id", "rid", lines, F.lit(0).cast("long").alias("n_removed"), none.alias("runs"), "text").unionByName(cut)
