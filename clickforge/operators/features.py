"""Feature specification, extraction and encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    HashingTF,
    IndexToString,
    OneHotEncoder,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickforge.functions import binary_entropy, hash_feature
from clickforge.functions.scalars import HASH_RANGE
from clickforge.operators.sparse import entry_rows
from clickforge.shared import broadcast_within, cut_lineage

# A feature with more listed values than this is matched by a broadcast join instead of a
# literal map, whose lookup is linear.
MAP_VALUES = 64
# Vocabulary entries that are sent to every executor.
BROADCAST_ROWS = 1_000_000
ROW_IN_PARTITION = (1 << 33) - 1
# Places of each entry of a value list that is too long to broadcast.
SALTS = 16
MAX_ID = (1 << 31) - 1


# ---------------------------------------------------------------- specification

def read_spec(spark: SparkSession, path: str) -> DataFrame:
    """Parsed specification file; see :func:`parse_spec`."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("line", "text"))
    return parse_spec(lines)


def parse_spec(lines: DataFrame) -> DataFrame:
    """``(line, name, class, depend, is_hash, hash_min, hash_max, ftype, values)`` per feature.

    ``lines`` is ``(line, text)``; a feature is ``name=..;class=..;...`` and blank and ``#`` lines
    are skipped. ``feat_type=0`` marks a quantity (``q``), everything else an indicator (``i``).
    """
    text = F.trim("text")
    fields = lines.filter((text != "") & ~text.startswith("#")).select(
        "line", F.str_to_map(text, F.lit(";"), F.lit("=")).alias("m"))
    get = lambda key: F.try_element_at("m", F.lit(key))
    return fields.select(
        "line",
        get("name").alias("name"),
        get("class").alias("class"),
        F.coalesce(get("depend"), get("name")).alias("depend"),
        F.coalesce(get("is_hash") == "true", F.lit(False)).alias("is_hash"),
        F.coalesce(get("hash_range_min").cast("int"), F.lit(HASH_RANGE[0])).alias("hash_min"),
        F.coalesce(get("hash_range_max").cast("int"), F.lit(HASH_RANGE[1])).alias("hash_max"),
        F.when(get("feat_type") == "0", "q").otherwise("i").alias("ftype"),
        F.when(get("feat_values") != "", F.split(get("feat_values"), ",")).alias("values"),
    )


def feature_ranges(spec: DataFrame) -> DataFrame:
    """``spec`` with ``hashed``, ``start`` and ``size``: each feature owns the ids from ``start`` up to ``start + size``.

    Ids go from 0 in file order. A feature has one id for each listed value, a hashed one (``is_hash`` and a hash range that
    is not empty) one for each bucket, and any other a single id. With an empty range ``is_hash`` has no effect.
    """
    hashed = F.col("is_hash") & (F.col("hash_min") < F.col("hash_max"))
    size = F.when(hashed, F.col("hash_max").cast("bigint") - F.col("hash_min")).when(
        F.size("values") > 0, F.size("values").cast("bigint")).otherwise(F.lit(1).cast("bigint"))
    # A specification has one line per feature of the model, so one ordered window is enough.
    before = Window.orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    sized = spec.withColumns({"hashed": hashed, "size": size})
    return sized.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0).cast("bigint")))


def feature_map(spec: DataFrame, expand_single: bool = True) -> DataFrame:
    """``(feature_id, name, ftype)``: ids as :func:`feature_ranges` gives them, listed values as ``name=value``.

    ``expand_single`` decides whether one listed value is expanded or leaves the plain name. A hashed feature has one row, with
    its plain name at its first id; :func:`named_features` names the others.
    """
    least = 1 if expand_single else 2
    listed = F.when(~F.col("hashed") & (F.size("values") >= least), F.transform("values", lambda v: F.concat_ws("=", "name", v)))
    names = F.coalesce(listed, F.array("name"))
    return feature_ranges(spec).select("start", "ftype", F.posexplode(names).alias("i", "name")).select(
        (F.col("start") + F.col("i")).cast("int").alias("feature_id"), "name", "ftype")


def named_features(df: DataFrame, spec: DataFrame, column: str = "f", start_index: int = 0, output: str = "name") -> DataFrame:
    """Append the name of each feature id: ``name``, ``name=value`` or, for a bucket of a hashed feature, ``name#bucket``.

    Ids outside the specification have no name. The intervals of the specification travel as a literal, one for each of its
    lines; value lists are joined by id, and broadcast only when counted.
    """
    ranges = feature_ranges(spec)
    # One entry per line of the specification; value lists stay where they are.
    spans = F.array(*[
        F.struct(F.lit(r["start"] + start_index).alias("start"), F.lit(r["size"]).alias("size"), F.lit(r["name"]).alias("name"),
                 F.lit(r["hash_min"]).alias("low"), F.lit(r["hashed"]).alias("hashed"))
        for r in ranges.select("line", "start", "size", "name", "hash_min", "hashed").orderBy("line").collect()])
    at = F.col(column)
    span = F.get(F.filter(spans, lambda s: (s["start"] <= at) & (at < s["start"] + s["size"])), F.lit(0))
    bucket = F.concat(span["name"], F.lit("#"), (at - span["start"] + span["low"]).cast("string"))
    listed = ranges.where(~F.col("hashed") & (F.size("values") > 0)).select(
        "start", "name", F.posexplode("values").alias("i", "value")).select(
        (F.col("start") + F.col("i") + start_index).alias("__id"), F.concat_ws("=", "name", "value").alias("__listed"))
    joined = df.withColumn("__span", F.when(span["hashed"], bucket).otherwise(span["name"])).join(
        broadcast_within(listed, BROADCAST_ROWS), at == F.col("__id"), "left")
    return joined.withColumn(output, F.coalesce("__listed", "__span")).drop("__span", "__id", "__listed")


def featurize(df: DataFrame, spec: DataFrame, keep: Sequence[str] = (), start_index: int = 0,
              output: str = "feats", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Append the sparse row that the specification describes.

    ``S_direct`` copies a number, ``S_onehot`` gives 1 at ``name=value`` (an unlisted value gives
    nothing), and a hashed feature gives 1 at its bucket. Ids are those of :func:`feature_ranges`, moved by ``start_index``; a
    specification whose ids pass the largest int is an error. The driver reads one line per feature; a value list beyond
    ``broadcast_rows`` stays in Spark and is joined by a salted key, everything else leaves rows unshuffled.
    """
    ranges = feature_ranges(spec)
    held = F.when(F.size("values") <= broadcast_rows, F.col("values")).alias("held")
    rows = ranges.select("line", "name", "class", "depend", "hashed", "hash_min", "hash_max", "start", "size",
                         (F.size("values") > 0).alias("listed"), held).orderBy("line").collect()
    if rows and start_index + rows[-1]["start"] + rows[-1]["size"] > MAX_ID:
        raise ValueError(f"{rows[-1]['start'] + rows[-1]['size']} feature ids do not fit: lower the hash ranges")
    entries: list[Column] = []
    dropped: list[str] = []
    one = F.lit(1.0)

    def entry(at: Column, value: Column) -> Column:
        return F.when(at.isNotNull() & value.isNotNull(), F.struct(at.cast("int").alias("f"), value.alias("v")))

    for r in rows:
        source = F.col(r["depend"])
        first = start_index + r["start"]
        if r["hashed"]:
            bucket = hash_feature(r["name"], source, r["hash_min"], r["hash_max"]) - r["hash_min"] + first
            entries.append(entry(bucket, one))
        elif r["listed"]:
            ids = {v: first + i for i, v in enumerate(r["held"] or ())}
            if r["held"] is not None and len(ids) <= MAP_VALUES:
                table = F.create_map(*[x for v, i in ids.items() for x in (F.lit(v), F.lit(i))])
                entries.append(entry(F.try_element_at(table, source.cast("string")), one))
                continue
            key, at = f"__k{first}", f"__f{first}"
            if r["held"] is not None:
                lookup = df.sparkSession.createDataFrame(list(ids.items()), f"`{key}` string, `{at}` int")
                df = df.join(F.broadcast(lookup), source.cast("string") == F.col(key), "left")
            else:
                df = _salted_lookup(df, ranges.where(F.col("line") == r["line"]), source.cast("string"), first, key, at)
            entries.append(entry(F.col(at), one))
            dropped += [key, at]
        else:
            value = source.cast("double") if r["class"] == "S_direct" else F.when(source.isNotNull(), one)
            entries.append(entry(F.lit(first), value))
    # Ids rise in the order of the entries, so the row is sorted as it stands.
    feats = F.filter(F.array(*entries), lambda s: s.isNotNull())
    df = df.withColumn(output, feats)
    return df.select(*keep, output) if keep else df.drop(*dropped)


def _salted_lookup(df: DataFrame, feature: DataFrame, value: Column, first: int, key: str, at: str) -> DataFrame:
    """``df`` with the value and the id of a long list's entry; each value lies in ``SALTS`` places, so a hot one is spread."""
    places = feature.select(F.posexplode("values").alias("i", key)).groupBy(key).agg((F.max("i") + first).alias(at))
    salt, place = f"__s{first}", f"__t{first}"
    places = places.withColumn(place, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # The row's own bits spread equal values; any salt finds the entry.
    salted = df.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return salted.join(places, (value == F.col(key)) & (F.col(salt) == F.col(place)), "left").drop(salt, place)


# ---------------------------------------------------------------- vocabularies

def category_long(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, column, value)`` with one row per category column."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    long = df.select(*keys, F.expr(f"stack({len(columns)}, {pairs}) AS (`column`, `value`)"))
    return long.filter(F.col("value").isNotNull())


def string_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n, index)``: values of each column by falling count, ties by text.

    All columns are counted in one job. The order is global over partitions: each sorted partition
    numbers its own rows and is shifted by what precedes it, so a large vocabulary is never sorted
    in one task. The sorted table is checkpointed because its numbering has to stay put.
    """
    counts = category_long(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
    ordered = counts.orderBy("column", F.desc("n"), "value").withColumn("__id", F.monotonically_increasing_id())
    ordered = cut_lineage(ordered).select(
        "column", "value", "n",
        F.shiftright("__id", 33).alias("__part"), F.col("__id").bitwiseAND(F.lit(ROW_IN_PARTITION)).alias("__row"))
    # One row per partition and column from here to the join.
    heads = ordered.groupBy("column", "__part").agg(F.count("*").alias("__size"), F.min("__row").alias("__first"))
    before = Window.partitionBy("column").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select("column", "__part", "__first",
                         F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    index = F.col("__offset") + F.col("__row") - F.col("__first")
    return ordered.join(F.broadcast(heads), ["column", "__part"]).select(
        "column", "value", "n", index.cast("int").alias("index"))


def one_hot(df: DataFrame, vocabulary: DataFrame, columns: Sequence[str], keys: Sequence[str],
            drop_last: bool = False) -> DataFrame:
    """``(keys, column, index)`` of the hot entry of each row; a dropped last category has none."""
    # A larger vocabulary is joined by shuffle, where adaptive execution splits hot categories.
    vocabulary = broadcast_within(vocabulary.select("column", "value", "index"), BROADCAST_ROWS)
    hot = category_long(df, columns, keys).join(vocabulary, ["column", "value"])
    if drop_last:
        last = vocabulary.groupBy("column").agg(F.max("index").alias("__last"))
        hot = hot.join(F.broadcast(last), "column").filter(F.col("index") < F.col("__last"))
    return hot.select(*keys, "column", "index")


def indexer(columns: Sequence[str], suffix: str = "_idx", invalid: str = "keep") -> StringIndexer:
    """MLlib indexer over several columns in one job."""
    return StringIndexer(inputCols=list(columns), outputCols=[c + suffix for c in columns],
                         stringOrderType="frequencyDesc", handleInvalid=invalid)


def index_to_string(column: str, output: str, labels: Sequence[str]) -> IndexToString:
    return IndexToString(inputCol=column, outputCol=output, labels=list(labels))


def one_hot_encoder(columns: Sequence[str], suffix: str = "_vec", drop_last: bool = False) -> OneHotEncoder:
    return OneHotEncoder(inputCols=list(columns), outputCols=[c + suffix for c in columns],
                         dropLast=drop_last, handleInvalid="keep")


def assembler(columns: Sequence[str], output: str = "features", invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid)


def stack_features(first: str | Column, second: str | Column, first_size: int) -> Column:
    """Sparse row of both sides; the ids of the second are moved behind the first."""
    moved = F.transform(second, lambda s: F.struct((s["f"] + first_size).cast("int").alias("f"), s["v"].alias("v")))
    return F.concat(first, moved)


def tokenizer(column: str = "text", output: str = "words") -> Tokenizer:
    return Tokenizer(inputCol=column, outputCol=output)


def hashing_tf(num_features: int, column: str = "words", output: str = "features") -> HashingTF:
    return HashingTF(inputCol=column, outputCol=output, numFeatures=num_features)


# ---------------------------------------------------------------- analysis

def information_gain(df: DataFrame, label: str, bin: str | Column, by: Sequence[str] = ()) -> DataFrame:
    """Entropy of the label less its mean entropy inside the bins, in bits."""
    bin = F.col(bin) if isinstance(bin, str) else bin
    positive = (F.col(label) == 1).cast("bigint")
    bins = df.groupBy(*by, bin.alias("__bin")).agg(F.count("*").alias("__n"), F.sum(positive).alias("__pos"))
    rate = F.col("__pos") / F.col("__n")
    total = F.sum("__n")
    inside = F.sum(F.col("__n") * binary_entropy(rate)) / total
    return bins.groupBy(*by).agg((binary_entropy(F.sum("__pos") / total) - inside).alias("gain"))


def feature_index_check(df: DataFrame, feats: str = "feats") -> DataFrame:
    """Sorted distinct feature ids that occur."""
    return entry_rows(df, feats).select("f").distinct().orderBy("f")
