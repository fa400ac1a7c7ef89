"""Queries over sources, scalar functions, features, set operations and splits."""

from __future__ import annotations

from datetime import date

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickforge import functions as fn
from clickforge.operators import features as feat
from clickforge.operators import splits as sp
from clickforge.operators.sparse import entry_rows, feats_to_vector
from clickforge.operators.trees import encode_leaves, ordinal_leaf_vocabulary, tree_leaf
from clickforge.plans import views
from clickforge.plans.catalog import IMP, LEAVES, ORDER_LINES, SPARSE, query
from clickforge.shared import drop_scratch, scratch_path
from clickforge.sources import (
    read_day_range,
    read_labelled_csv,
    read_libsvm,
    read_sparse_text,
    read_sql,
    read_typed_csv,
    write_libsvm,
)

# ---------------------------------------------------------------- sources


@query("""
SELECT event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY event_type""")
def read_sql_view(spark, sf):
    views.table(spark, sf, "events").createOrReplaceTempView("events_view")
    return read_sql(spark, "SELECT event_type, count(*) AS n, round(sum(value), 6) AS total "
                           "FROM events_view GROUP BY event_type")


@query(f"""
WITH {IMP} SELECT dt, count(*) AS n, CAST(sum(label) AS BIGINT) AS clicks FROM imp
WHERE dt BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' GROUP BY dt""")
def path_range_days(spark, sf):
    days = views.impressions(spark, sf).filter(F.col("dt").between("2024-01-05", "2024-01-12"))
    return days.groupBy("dt").agg(F.count("*").alias("n"), F.sum("label").cast("bigint").alias("clicks"))


def _settled(spark, found, path):
    """The rows of a small aggregate, whose scratch table then goes."""
    rows = found.collect()
    drop_scratch(spark, path)
    return spark.createDataFrame(rows, found.schema)


@query(f"""
WITH {IMP} SELECT dt, count(*) AS n, CAST(sum(label) AS BIGINT) AS clicks, round(sum(value), 4) AS total FROM imp
WHERE dt BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' GROUP BY dt""")
def read_days(spark, sf):
    """A table laid out by day, read for a range of days."""
    path = scratch_path(spark, "days")
    views.impressions(spark, sf).select("dt", "label", "value").write.partitionBy("dt").parquet(path)
    days = read_day_range(spark, path, date(2024, 1, 5), date(2024, 1, 12))
    return _settled(spark, days.groupBy("dt").agg(
        F.count("*").alias("n"), F.sum("label").cast("bigint").alias("clicks"), F.round(F.sum("value"), 4).alias("total")), path)


@query(f"""
WITH {IMP} SELECT CAST(label AS INTEGER) AS label, count(*) AS n, round(sum(value), 4) AS total, CAST(sum(hour_of_day) AS BIGINT) AS hours
FROM imp WHERE value IS NOT NULL AND dt BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' GROUP BY label""")
def read_labelled_csv_range(spark, sf):
    """Dense CSV with the label last, from a path with a range of numbers."""
    path = scratch_path(spark, "csv")
    january = views.impressions(spark, sf).where("value IS NOT NULL AND dt BETWEEN '2024-01-01' AND '2024-01-31'")
    january.select("value", "hour_of_day", "label", F.dayofmonth("dt").alias("d")).write.partitionBy("d").csv(path)
    rows = read_labelled_csv(spark, path + "/d=[5-12]", num_columns=3).withColumn("x", vector_to_array("features"))
    return _settled(spark, rows.groupBy(F.col("label").cast("int").alias("label")).agg(
        F.count("*").alias("n"), F.round(F.sum(F.col("x")[0]), 4).alias("total"), F.sum(F.col("x")[1]).cast("bigint").alias("hours")), path)


@query("""
SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 4) AS balance, count(DISTINCT c_nationkey) AS nations
FROM customer GROUP BY c_mktsegment""")
def read_typed_csv_rows(spark, sf):
    """CSV with a declared schema, its id column left out."""
    path = scratch_path(spark, "typed")
    views.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey").write.csv(path)
    rows = read_typed_csv(spark, path, "index long, c_mktsegment string, c_acctbal double, c_nationkey int")
    return _settled(spark, rows.groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 4).alias("balance"), F.countDistinct("c_nationkey").alias("nations")), path)


@query(f"""
WITH {SPARSE} SELECT f, CAST(label AS INTEGER) AS label, count(*) AS n, round(sum(v), 6) AS total
FROM sparse JOIN imp USING (row_id) GROUP BY f, label""")
def sparse_text_roundtrip(spark, sf):
    path = scratch_path(spark, "rows")
    write_libsvm(views.sparse_rows(spark, sf).select("label", "feats"), path)
    rows = entry_rows(read_sparse_text(spark, path), "feats", ["label"])
    return rows.groupBy("f", F.col("label").cast("int").alias("label")).agg(
        F.count("*").alias("n"), F.round(F.sum("v"), 6).alias("total"))


@query(f"""
WITH {SPARSE} SELECT CAST(label AS INTEGER) AS label, count(DISTINCT row_id) AS n, count(*) FILTER (WHERE v <> 0) AS entries
FROM sparse JOIN imp USING (row_id) GROUP BY label""")
def libsvm_roundtrip(spark, sf):
    path = scratch_path(spark, "libsvm")
    write_libsvm(views.sparse_rows(spark, sf).select("label", "feats"), path)
    stored = F.size(F.filter(F.unwrap_udt("features")["values"], lambda v: v != 0))
    rows = read_libsvm(spark, path, views.SPEC_SIZE)
    return rows.groupBy(F.col("label").cast("int").alias("label")).agg(
        F.count("*").alias("n"), F.sum(stored).cast("bigint").alias("entries"))


# ---------------------------------------------------------------- scalar functions


@query(f"""
WITH {LEAVES} SELECT row_id, CAST(l0 AS VARCHAR) AS leaf_0, CAST(l1 AS VARCHAR) AS leaf_1,
CAST(l2 AS VARCHAR) AS leaf_2, CAST(NULL AS VARCHAR) AS leaf_3 FROM leaves""")
def array_to_columns(spark, sf):
    leaves = tree_leaf(views.sparse_rows(spark, sf), views.fixed_model(), "feats")
    return leaves.select("row_id", *[F.get("leaves", F.lit(i)).cast("string").alias(f"leaf_{i}") for i in range(4)])


@query(f"WITH {IMP} SELECT row_id, dt, value FROM imp WHERE label = 1")
def label_filter(spark, sf):
    return views.impressions(spark, sf).filter("label = 1").select("row_id", "dt", "value")


@query(f"WITH {IMP} SELECT row_id, round(1e0 / (1e0 + exp(-margin0)), 6) AS p FROM imp")
def sigmoid(spark, sf):
    return views.impressions(spark, sf).select("row_id", F.round(fn.sigmoid(F.col("margin0")), 6).alias("p"))


RATES = "rates AS (SELECT user_id, avg(label) AS rate FROM imp GROUP BY user_id)"


def _rates(spark, sf):
    return views.impressions(spark, sf).groupBy("user_id").agg(F.avg("label").alias("rate"))


@query(f"""
WITH {IMP}, {RATES} SELECT user_id, round(CASE WHEN rate > 0 AND rate < 1
THEN -rate * log2(rate) - (1 - rate) * log2(1 - rate) ELSE 0e0 END, 6) AS bits FROM rates""")
def binary_entropy(spark, sf):
    return _rates(spark, sf).select("user_id", F.round(fn.binary_entropy(F.col("rate")), 6).alias("bits"))


UNIT = "unit AS (SELECT *, (least(greatest(rate, 2e-3), 3e-1) - 2e-3) / (3e-1 - 2e-3) AS u FROM rates)"


@query(f"WITH {IMP}, {RATES}, {UNIT} SELECT user_id, round(u, 6) AS shaped FROM unit")
def domain_transform(spark, sf):
    return _rates(spark, sf).select("user_id", F.round(fn.domain_transform(F.col("rate")), 6).alias("shaped"))


@query(f"""
WITH {IMP}, {RATES}, {UNIT} SELECT user_id, round(u, 6) AS linear,
round(ln(1 + 100 * u) / ln(101e0), 6) AS logarithmic, round(sqrt(u), 6) AS root FROM unit""")
def ctr_shapes(spark, sf):
    rate = F.col("rate")
    return _rates(spark, sf).select(
        "user_id", F.round(fn.domain_transform(rate, fn.linear_shape), 6).alias("linear"),
        F.round(fn.domain_transform(rate, fn.log_shape), 6).alias("logarithmic"),
        F.round(fn.domain_transform(rate, fn.sqrt_shape), 6).alias("root"))


@query(f"WITH {IMP}, {RATES} SELECT user_id, round(rate / (rate + 1e-2), 6) AS gray FROM rates")
def mat2gray(spark, sf):
    return _rates(spark, sf).select("user_id", F.round(fn.mat2gray(F.col("rate")), 6).alias("gray"))


SPANS = "spans AS (SELECT user_id, min(dt) AS lo, max(dt) AS hi FROM imp GROUP BY user_id)"


@query(f"""
WITH {IMP}, {SPANS}, days AS (
  SELECT 'forward' AS kind, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM spans
  UNION ALL SELECT 'backward', CASE WHEN hi >= lo THEN hi END FROM spans)
SELECT kind, d, count(*) AS n FROM days GROUP BY kind, d""")
def date_seq(spark, sf):
    spans = views.impressions(spark, sf).groupBy("user_id").agg(F.min("dt").alias("lo"), F.max("dt").alias("hi"))
    forward = spans.select(F.lit("forward").alias("kind"), F.explode(fn.date_sequence(F.col("lo"), F.col("hi"))).alias("d"))
    # The end lies before the begin, so only the begin is left.
    backward = spans.select(F.lit("backward").alias("kind"), F.explode(fn.date_sequence(F.col("hi"), F.col("lo"))).alias("d"))
    return forward.unionByName(backward).groupBy("kind", "d").agg(F.count("*").alias("n"))


@query(f"WITH {IMP} SELECT DISTINCT dt, dt - 10 AS before_10, dt + 12 AS after_12 FROM imp")
def date_shift(spark, sf):
    return views.impressions(spark, sf).select("dt").distinct().select(
        "dt", fn.shift_days(F.col("dt"), -10).alias("before_10"), fn.shift_days(F.col("dt"), 12).alias("after_12"))


@query(f"""
WITH {IMP}, e AS (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS sec, CAST(ts + INTERVAL 8 HOUR AS DATE) AS d FROM imp),
b AS (SELECT *, CAST(epoch(CAST(d AS TIMESTAMP)) AS BIGINT) - 28800 AS "start" FROM e)
SELECT d, "start", "start" + 86400 AS stop, count(*) AS n,
CAST(sum(CASE WHEN sec >= "start" AND sec < "start" + 86400 THEN 1 ELSE 0 END) AS BIGINT) AS inside
FROM b GROUP BY d, "start" """)
def epoch_day_range(spark, sf):
    epoch = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
    events = views.impressions(spark, sf).select(
        epoch.alias("sec"), F.to_date(F.expr("ts + INTERVAL 8 HOURS")).alias("d"))
    bounded = events.select("sec", "d", fn.day_bounds(F.col("d")).alias("b")).select("sec", "d", "b.*")
    inside = ((F.col("sec") >= F.col("start")) & (F.col("sec") < F.col("stop"))).cast("bigint")
    return bounded.groupBy("d", "start", "stop").agg(F.count("*").alias("n"), F.sum(inside).alias("inside"))


@query("SELECT event_id, value FROM events")
def column_prune(spark, sf):
    return views.table(spark, sf, "events").drop("ts", "user_id", "event_type", "props")


# ---------------------------------------------------------------- features


@query("""
WITH names AS (
  SELECT 1 AS line, 0 AS i, 'retailprice' AS name, 'q' AS ftype
  UNION ALL SELECT 2, CAST(row_number() OVER (ORDER BY p_type) - 1 AS INTEGER), 'type=' || p_type, 'i' FROM (SELECT DISTINCT p_type FROM part)
  UNION ALL SELECT 3, CAST(row_number() OVER (ORDER BY p_brand) - 1 AS INTEGER), 'brand=' || p_brand, 'i' FROM (SELECT DISTINCT p_brand FROM part))
SELECT CAST(row_number() OVER (ORDER BY line, i) - 1 AS INTEGER) AS feature_id, name, ftype FROM names""")
def feature_map(spark, sf):
    """The map of a specification whose value lists are what the part table holds."""
    part = views.table(spark, sf, "part")

    def line(number, name, column):
        listed = F.array_join(F.sort_array(F.collect_set(column)), ",")
        text = F.concat(F.lit(f"name={name};class=S_onehot;slot={number};depend={column};is_hash=false;feat_values="), listed)
        return part.agg(F.lit(number).alias("line"), text.alias("text"))

    price = "name=retailprice;class=S_direct;slot=1;depend=p_retailprice;is_hash=false;feat_type=0"
    numeric = part.agg(F.lit(1).alias("line"), F.lit(price).alias("text"))
    lines = sp.union_all([numeric, line(2, "type", "p_type"), line(3, "brand", "p_brand")])
    return feat.feature_map(feat.parse_spec(lines))


@query(f"WITH {SPARSE} SELECT row_id, f, round(v, 6) AS v FROM sparse")
def featurize(spark, sf):
    rows = entry_rows(views.sparse_rows(spark, sf), "feats", ["row_id"])
    return rows.select("row_id", "f", F.round("v", 6).alias("v"))


@query(f"""
WITH {IMP}, long AS (
  SELECT row_id, 0 AS f, 'value' AS name, CAST(value AS DOUBLE) AS v FROM imp WHERE value IS NOT NULL
  UNION ALL SELECT row_id, 1 + b, 'user#' || CAST(b + 100 AS VARCHAR), 1e0 FROM (
    SELECT row_id, CAST(CAST(('0x' || substr(md5('user=' || user_id), 1, 8)) AS BIGINT) % 900 AS INTEGER) AS b FROM imp WHERE user_id IS NOT NULL)
  UNION ALL SELECT row_id, 901 + CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END, 'type=' || event_type, 1e0
    FROM imp WHERE event_type IN ('view', 'click', 'signup')
  UNION ALL SELECT row_id, 904, 'k', CAST(k_seen AS DOUBLE) FROM imp WHERE k_seen IS NOT NULL)
SELECT row_id, CAST(f AS INTEGER) AS f, name, round(v, 6) AS v FROM long""")
def featurize_named(spark, sf):
    """Rows of a specification with a hashed feature in the middle, each id with its name."""
    lines = ["name=value;class=S_direct;depend=value;feat_type=0",
             "name=user;class=S_onehot;depend=user_id;is_hash=true;hash_range_min=100;hash_range_max=1000",
             "name=type;class=S_onehot;depend=event_type;is_hash=false;feat_values=view,click,signup",
             "name=k;class=S_direct;depend=k_seen;is_hash=true;hash_range_min=5;hash_range_max=5;feat_type=0"]
    spec = feat.parse_spec(spark.createDataFrame(list(enumerate(lines)), "line int, text string"))
    rows = entry_rows(feat.featurize(views.impressions(spark, sf), spec), "feats", ["row_id"])
    return feat.named_features(rows, spec).select("row_id", "f", "name", F.round("v", 6).alias("v"))


@query("""
SELECT o_orderkey, CAST(('0x' || substr(md5('priority=' || o_orderpriority), 1, 8)) AS BIGINT) % 1000 AS small,
CAST(('0x' || substr(md5('customer=' || o_custkey), 1, 8)) AS BIGINT) % 10000000 AS wide FROM orders""")
def hash_feature(spark, sf):
    return views.table(spark, sf, "orders").select(
        "o_orderkey", fn.hash_feature("priority", F.col("o_orderpriority"), 0, 1000).alias("small"),
        fn.hash_feature("customer", F.col("o_custkey")).alias("wide"))


CATEGORIES = ["o_orderpriority", "c_mktsegment", "p_type", "p_brand"]


@query(f"""
WITH {ORDER_LINES}, long AS (
  SELECT unnest(['o_orderpriority', 'c_mktsegment', 'p_type', 'p_brand']) AS col,
         unnest([o_orderpriority, c_mktsegment, p_type, p_brand]) AS val FROM ol),
counts AS (SELECT col, val, count(*) AS n FROM long WHERE val IS NOT NULL GROUP BY col, val)
SELECT col, val, n, CAST(row_number() OVER (PARTITION BY col ORDER BY n DESC, val) - 1 AS INTEGER) AS idx FROM counts""")
def string_index(spark, sf):
    vocabulary = feat.string_index(views.order_lines(spark, sf), CATEGORIES)
    return vocabulary.select(F.col("column").alias("col"), F.col("value").alias("val"), "n", F.col("index").alias("idx"))


EVENT_VOCABULARY = f"""
{IMP}, long AS (
  SELECT row_id, unnest(['event_type', 'hour_of_day']) AS col, unnest([event_type, CAST(hour_of_day AS VARCHAR)]) AS val FROM imp),
counts AS (SELECT col, val, count(*) AS n FROM long GROUP BY col, val),
vocab AS (SELECT *, CAST(row_number() OVER (PARTITION BY col ORDER BY n DESC, val) - 1 AS INTEGER) AS idx FROM counts)"""


@query(f"WITH {EVENT_VOCABULARY} SELECT row_id, col, idx FROM long JOIN vocab USING (col, val)")
def one_hot(spark, sf):
    rows = views.impressions(spark, sf)
    columns = ["event_type", "hour_of_day"]
    hot = feat.one_hot(rows, feat.string_index(rows, columns), columns, ["row_id"])
    return hot.select("row_id", F.col("column").alias("col"), F.col("index").alias("idx"))


@query(f"""
WITH {EVENT_VOCABULARY}, last AS (SELECT col, max(idx) AS m FROM vocab GROUP BY col)
SELECT row_id, col, idx FROM long JOIN vocab USING (col, val) JOIN last USING (col) WHERE idx < m""")
def one_hot_drop_last(spark, sf):
    rows = views.impressions(spark, sf)
    columns = ["event_type", "hour_of_day"]
    hot = feat.one_hot(rows, feat.string_index(rows, columns), columns, ["row_id"], drop_last=True)
    return hot.select("row_id", F.col("column").alias("col"), F.col("index").alias("idx"))


@query(f"""
WITH {EVENT_VOCABULARY} SELECT row_id, val AS event_type, CAST(idx AS DOUBLE) AS idx, val AS restored
FROM long JOIN vocab USING (col, val) WHERE col = 'event_type'""")
def index_to_string(spark, sf):
    rows = views.impressions(spark, sf).select("row_id", "event_type")
    model = feat.indexer(["event_type"]).fit(rows)
    back = feat.index_to_string("event_type_idx", "restored", model.labelsArray[0])
    return back.transform(model.transform(rows)).select(
        "row_id", "event_type", F.col("event_type_idx").alias("idx"), "restored")


@query(f"""
WITH {LEAVES}, offsets(tree, o) AS (VALUES (0, 0), (1, 4), (2, 7)),
ordinal AS (SELECT tree, leaf, row_number() OVER (PARTITION BY tree ORDER BY leaf) - 1 + o AS pos FROM leaf_value JOIN offsets USING (tree))
SELECT row_id, CAST(pos AS INTEGER) AS f, 1e0 AS v FROM leaf_long JOIN ordinal USING (tree, leaf)
UNION ALL SELECT row_id, 10, CAST(value AS DOUBLE) FROM imp WHERE value IS NOT NULL
UNION ALL SELECT row_id, 11, CAST(k_seen AS DOUBLE) FROM imp WHERE k_seen IS NOT NULL""")
def feature_stack(spark, sf):
    model = views.fixed_model()
    leaved = tree_leaf(views.sparse_rows(spark, sf), model, "feats")
    encoded = encode_leaves(leaved, ordinal_leaf_vocabulary(spark, model))
    hot = F.transform("onehot", lambda i: F.struct(i.alias("f"), F.lit(1.0).alias("v")))
    numeric = F.filter("feats", lambda s: s["f"] < 2)
    return entry_rows(encoded, feat.stack_features(hot, numeric, 10), ["row_id"])


@query("""
WITH words AS (SELECT unnest(string_split_regex(lower(text), '[ \\t\\n\\x0B\\f\\r]')) AS word FROM documents)
SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY word""")
def tokenize(spark, sf):
    tokens = feat.tokenizer().transform(views.table(spark, sf, "documents").select("text"))
    # An outer generator keeps the tokens from being made twice, see ``entry_rows``.
    words = tokens.select(F.explode_outer("words").alias("word"))
    return words.filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


GAIN_BINS = "gb AS (SELECT *, CAST(floor(value / 25) AS INTEGER) AS bin FROM imp)"


@query(f"""
WITH {IMP}, {GAIN_BINS}, b AS (
  SELECT split, bin, count(*) AS n, sum(planted) AS pos FROM gb GROUP BY split, bin),
r AS (SELECT *, pos / CAST(n AS DOUBLE) AS p FROM b),
t AS (SELECT split, sum(n) AS n, sum(pos) / CAST(sum(n) AS DOUBLE) AS p,
      sum(n * CASE WHEN p > 0 AND p < 1 THEN -p * log2(p) - (1 - p) * log2(1 - p) ELSE 0e0 END) / sum(n) AS inside
      FROM r GROUP BY split)
SELECT split, round(CASE WHEN p > 0 AND p < 1 THEN -p * log2(p) - (1 - p) * log2(1 - p) ELSE 0e0 END - inside, 6) AS gain FROM t""")
def info_gain(spark, sf):
    rows = views.impressions(spark, sf)
    bins = F.floor(F.col("value") / 25).cast("int")
    return feat.information_gain(rows, "planted", bins, ["split"]).select("split", F.round("gain", 6).alias("gain"))


@query(f"WITH {SPARSE} SELECT DISTINCT f FROM sparse")
def feature_index_check(spark, sf):
    return feat.feature_index_check(views.sparse_rows(spark, sf))


@query(f"""
WITH {IMP}, {RATES}, {UNIT}, b AS (
  SELECT least(9, CAST(floor(10 * u) AS INTEGER)) AS linear,
         least(9, CAST(floor(10 * (ln(1 + 100 * u) / ln(101e0))) AS INTEGER)) AS logarithmic FROM unit)
SELECT linear, logarithmic, count(*) AS users FROM b GROUP BY linear, logarithmic""")
def ctr_bucketize(spark, sf):
    rate = F.col("rate")
    bins = _rates(spark, sf).select(
        fn.bucketize_rate(rate, 10).alias("linear"), fn.bucketize_rate(rate, 10, fn.log_shape).alias("logarithmic"))
    return bins.groupBy("linear", "logarithmic").agg(F.count("*").alias("users"))


@query()
def hashing_tf(spark, sf):
    docs = views.table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = feat.tokenizer().transform(docs)
    hashed = feat.hashing_tf(1000).transform(words)
    values = F.unwrap_udt("features")["values"]
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return hashed.select("doc_id", F.size(values).alias("terms"), total.alias("words"))


@query(f"""
WITH {SPARSE} SELECT row_id, count(*) AS stored, round(sum(v), 6) AS total FROM sparse GROUP BY row_id""")
def sparse_vector(spark, sf):
    rows = views.sparse_rows(spark, sf).select("row_id", feats_to_vector("feats", views.SPEC_SIZE).alias("features"))
    values = F.unwrap_udt("features")["values"]
    return rows.select("row_id", F.size(values).cast("bigint").alias("stored"),
                       F.round(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), 6).alias("total"))


# ---------------------------------------------------------------- sets and splits

DAY_FILES = ["2024-01-03", "2024-01-04", "2024-01-05"]


def _days(spark, sf):
    rows = views.impressions(spark, sf)
    return [rows.filter(F.col("dt") == day).select("user_id", "event_type", "hour_of_day", "label") for day in DAY_FILES]


@query(f"""
WITH {IMP}, d AS (SELECT user_id, event_type, hour_of_day, label FROM imp WHERE dt BETWEEN DATE '2024-01-03' AND DATE '2024-01-05')
SELECT event_type, hour_of_day, count(*) AS n FROM d GROUP BY event_type, hour_of_day""")
def union_days(spark, sf):
    return sp.union_all(_days(spark, sf)).groupBy("event_type", "hour_of_day").agg(F.count("*").alias("n"))


@query(f"""
WITH {IMP} SELECT DISTINCT user_id, event_type, hour_of_day, label FROM imp
WHERE dt BETWEEN DATE '2024-01-03' AND DATE '2024-01-05'""")
def distinct_rows(spark, sf):
    days = _days(spark, sf)
    return sp.union_distinct([*days, days[0]])


@query(f"""
WITH {IMP} SELECT CASE WHEN dt < DATE '2024-01-21' THEN 'train' ELSE 'test' END AS split, event_type, count(*) AS n
FROM imp GROUP BY 1, 2""")
def concat_tagged(spark, sf):
    rows = views.impressions(spark, sf).drop("split")
    tagged = sp.concat_tagged({"train": rows.filter("dt < DATE '2024-01-21'"), "test": rows.filter("dt >= DATE '2024-01-21'")})
    return tagged.groupBy("split", "event_type").agg(F.count("*").alias("n"))


@query("""
SELECT CASE WHEN (l_orderkey * 1103515245 + 12345) % 2147483648 < 1932735283 THEN 'train' ELSE 'test' END AS split,
count(*) AS n, round(sum(l_quantity), 6) AS quantity FROM lineitem GROUP BY 1""")
def key_split(spark, sf):
    lines = views.table(spark, sf, "lineitem")
    split = sp.key_split("l_orderkey", [0.9, 0.1], ["train", "test"])
    return lines.groupBy(split.alias("split")).agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 6).alias("quantity"))


@query(f"""
WITH {IMP} SELECT CASE WHEN dt BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' THEN 'train' ELSE 'test' END AS split,
dt, count(*) AS n FROM imp WHERE dt BETWEEN DATE '2024-01-10' AND DATE '2024-01-13' GROUP BY 1, 2""")
def time_split(spark, sf):
    split = sp.time_split("dt", ("2024-01-10", "2024-01-12"), ("2024-01-13", "2024-01-13"))
    rows = views.impressions(spark, sf).filter(F.col("dt").between("2024-01-10", "2024-01-13"))
    return rows.groupBy(split.alias("split"), "dt").agg(F.count("*").alias("n"))


@query(f"""
WITH {IMP} SELECT CAST(floor(mix * 5 / 2147483648e0) AS INTEGER) AS fold, count(*) AS n, CAST(sum(label) AS BIGINT) AS clicks
FROM imp GROUP BY 1""")
def k_fold(spark, sf):
    rows = views.impressions(spark, sf)
    return rows.groupBy(sp.k_fold("row_id", 5).alias("fold")).agg(
        F.count("*").alias("n"), F.sum("label").cast("bigint").alias("clicks"))


@query()
def random_split(spark, sf):
    parts = sp.random_split(views.impressions(spark, sf).drop("split"), [0.6, 0.2, 0.1, 0.1])
    tagged = sp.concat_tagged({f"part_{i}": p for i, p in enumerate(parts)})
    return tagged.groupBy("split").agg(F.count("*").alias("n"))


@query(f"""
WITH {IMP} SELECT label, row_id, value FROM imp
QUALIFY row_number() OVER (PARTITION BY label ORDER BY row_id) <= 10""")
def sample_per_label(spark, sf):
    return sp.head_per_group(views.impressions(spark, sf).select("label", "row_id", "value"), "label", "row_id", 10)


@query(f"""
WITH {IMP}, s AS (SELECT event_type, CAST(sum(planted) AS BIGINT) AS hits FROM imp GROUP BY event_type)
SELECT event_type, hits, CAST(row_number() OVER (ORDER BY hits DESC, event_type) AS INTEGER) AS place FROM s""")
def sort_descending(spark, sf):
    sums = views.impressions(spark, sf).groupBy("event_type").agg(F.sum("planted").alias("hits"))
    # A handful of groups is left to order.
    place = F.row_number().over(Window.orderBy(F.desc("hits"), "event_type"))
    return sums.select("event_type", "hits", place.alias("place"))
