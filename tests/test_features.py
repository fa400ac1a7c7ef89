import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickforge.operators import features as feat
from clickforge.operators import splits as sp
from clickforge.operators.sparse import feats_column, feats_to_vector


def spec(spark, lines):
    return feat.parse_spec(spark.createDataFrame(list(enumerate(lines)), "line int, text string"))


def test_featurize_with_literal_map_join_and_hash(spark):
    wide = ",".join(f"w{i}" for i in range(feat.MAP_VALUES + 10))
    lines = ["name=x;class=S_direct;depend=x;feat_type=0", f"name=wide;class=S_onehot;depend=wide;feat_values={wide}",
             "name=small;class=S_onehot;depend=small;feat_values=a,b", "name=h;class=S_onehot;depend=h;is_hash=true;hash_range_max=1000"]
    df = spark.createDataFrame([(1, 2.5, "w70", "b", "1-URGENT"), (2, None, "nope", None, None)],
                               "id int, x double, wide string, small string, h string")
    hashed = df.select(F.lit("h"), "h")
    rows = {r["id"]: [(e["f"], e["v"]) for e in r["feats"]] for r in feat.featurize(df, spec(spark, lines)).collect()}
    n = feat.MAP_VALUES + 10
    bucket = hashed.select(feat.hash_feature("h", F.lit("1-URGENT"), 0, 1000)).first()[0]
    assert rows == {1: [(0, 2.5), (71, 1.0), (1 + n + 1, 1.0), (1 + n + 2 + bucket, 1.0)], 2: []}
    assert "Exchange hashpartitioning" not in feat.featurize(df, spec(spark, lines))._jdf.queryExecution().toString()


def test_map_row_and_names_agree_with_a_hashed_feature_in_the_middle(spark):
    lines = ["name=h;class=S_onehot;depend=h;is_hash=true;hash_range_min=10;hash_range_max=30",
             "name=b;class=S_onehot;depend=b;feat_values=p,q",
             "name=e;class=S_onehot;depend=e;is_hash=true;hash_range_min=7;hash_range_max=7;feat_values=1"]
    parsed = spec(spark, lines)
    assert [tuple(r) for r in feat.feature_map(parsed).orderBy("feature_id").collect()] == [
        (0, "h", "i"), (20, "b=p", "i"), (21, "b=q", "i"), (22, "e=1", "i")]
    df = spark.createDataFrame([("x", "q", "1"), (None, "z", "2")], "h string, b string, e string")
    rows = feat.featurize(df, parsed, start_index=5).select("h", F.inline("feats"))
    named = {r["name"]: r["f"] for r in feat.named_features(rows, parsed, start_index=5).collect()}
    bucket = df.select(feat.hash_feature("h", F.lit("x"), 10, 30)).first()[0]
    assert named == {f"h#{bucket}": 5 + bucket - 10, "b=q": 26, "e=1": 27}
    outside = feat.named_features(spark.createDataFrame([(23,), (-1,), (None,)], "f int"), parsed)
    assert [r["name"] for r in outside.collect()] == [None, None, None]


def test_long_value_lists_join_by_a_salted_key(spark):
    listed = ",".join(f"w{i}" for i in range(200)) + ",w7"
    parsed = spec(spark, [f"name=w;class=S_onehot;depend=w;feat_values={listed}", "name=x;class=S_direct;depend=x;feat_type=0"])
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 != 0, F.concat(F.lit("w"), F.when(F.col("id") % 3 == 1, 7).otherwise(F.col("id") % 250))).alias("w"), F.lit(1.0).alias("x"))
    salted, sent = feat.featurize(df, parsed, broadcast_rows=100), feat.featurize(df, parsed)
    assert salted.columns == sent.columns == ["id", "w", "x", "feats"]
    assert sorted(map(str, salted.collect())) == sorted(map(str, sent.collect()))


def test_ids_beyond_int_are_an_error(spark):
    lines = [f"name=h{i};class=S_onehot;depend=h;is_hash=true" for i in range(215)]
    with pytest.raises(ValueError, match="do not fit"):
        feat.featurize(spark.createDataFrame([("x",)], "h string"), spec(spark, lines))


def test_string_index_orders_by_count_then_text(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y"), ("c", None)], "p string, q string")
    rows = {(r["column"], r["value"]): (r["n"], r["index"]) for r in feat.string_index(df, ["p", "q"]).collect()}
    assert rows == {("p", "c"): (2, 0), ("p", "a"): (1, 1), ("p", "b"): (1, 2), ("q", "x"): (2, 0), ("q", "y"): (1, 1)}


def test_string_index_is_dense_over_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 1700).cast("string").alias("v"), (F.col("id") % 3).cast("string").alias("w"))
    indexed = feat.string_index(df.repartition(7), ["v", "w"])
    check = indexed.groupBy("column").agg(F.count("*").alias("n"), F.countDistinct("index").alias("d"), F.max("index").alias("m"))
    assert {tuple(r) for r in check.collect()} == {("v", 1700, 1700, 1699), ("w", 3, 3, 2)}


def test_mllib_indexer_agrees(spark):
    df = spark.createDataFrame([(v,) for v in "abbcccdd"], "v string")
    model = feat.indexer(["v"]).fit(df)
    ours = {r["value"]: r["index"] for r in feat.string_index(df, ["v"]).collect()}
    assert {w: i for i, w in enumerate(model.labelsArray[0])} == ours


def test_information_gain_of_a_perfect_bin_is_the_entropy(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (0, 1), (0, 2)], "label int, bin int")
    assert feat.information_gain(df, "label", "bin").first()["gain"] == pytest.approx(1.0)


def test_vector_conversions_round_trip(spark):
    df = spark.createDataFrame([(1, Vectors.sparse(6, [1, 4], [2.0, 3.0])), (2, Vectors.dense([1.0, 0.0]))], ["id", "v"])
    rows = df.select("id", feats_column(df, "v").alias("feats"))
    assert [[(e["f"], e["v"]) for e in r["feats"]] for r in rows.orderBy("id").collect()] == [
        [(1, 2.0), (4, 3.0)], [(0, 1.0), (1, 0.0)]]
    back = rows.select("id", feats_to_vector("feats", 6).alias("v")).orderBy("id").collect()
    assert back[0]["v"] == Vectors.sparse(6, [1, 4], [2.0, 3.0])
    assert back[1]["v"] == Vectors.sparse(6, [0, 1], [1.0, 0.0])


def test_one_hot_encoder_keeps_unseen(spark):
    train, test = spark.createDataFrame([("a",), ("b",)], "c string"), spark.createDataFrame([("z",)], "c string")
    index = feat.indexer(["c"]).fit(train)
    encoder = feat.one_hot_encoder(["c_idx"]).fit(index.transform(train))
    assert encoder.transform(index.transform(test)).first()["c_idx_vec"].numNonzeros() == 1


def test_key_split_does_not_depend_on_partitioning(spark):
    df = spark.range(10_000)
    split = sp.key_split("id", [0.6, 0.3, 0.1], ["a", "b", "c"]).alias("s")
    one = df.select("id", split)
    assert one.exceptAll(df.repartition(13).select("id", split)).count() == 0
    shares = {r["s"]: r["n"] / 10_000 for r in one.groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert shares["a"] == pytest.approx(0.6, abs=0.03) and shares["c"] == pytest.approx(0.1, abs=0.02)


def test_mix_key_takes_large_keys(spark):
    assert 0 <= spark.range(1).select(sp.mix_key(F.lit(9_000_000_000_000_000_000))).first()[0] < 2**31


def test_random_split_keeps_all_rows(spark):
    parts = sp.random_split(spark.range(1000), [0.9, 0.1])
    assert sum(p.count() for p in parts) == 1000


def test_head_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("g"))
    top = sp.head_per_group(df, "g", "id", 3)
    assert sorted(r["id"] for r in top.collect()) == [0, 1, 2, 3, 4, 5]
    assert "WindowGroupLimit" in top._jdf.queryExecution().toString()
