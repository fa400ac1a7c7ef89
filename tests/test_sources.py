import pytest
from pyspark.sql import functions as F

from clickforge.operators.features import feature_map, parse_spec, read_spec
from clickforge.operators.linear import linear_score, logistic_regression
from clickforge.operators.metrics import same_predictions
from clickforge.operators.sparse import feats_from_vector
from clickforge.sources import (
    expand_path_range,
    read_day_range,
    read_labelled_csv,
    read_libsvm,
    read_linear_model,
    read_sparse_text,
    read_typed_csv,
    write_libsvm,
    write_linear_model,
)


def test_expand_path_range():
    assert expand_path_range("/x/dt=20200713/instance") == ["/x/dt=20200713/instance"]
    parts = expand_path_range("/x/part-00[100-199]")
    assert len(parts) == 100 and parts[0] == "/x/part-00100" and parts[-1] == "/x/part-00199"
    assert expand_path_range("/a[1-2]/b[3-4]") == ["/a1/b[3-4]", "/a2/b[3-4]"]
    assert expand_path_range("/d[9-11]") == ["/d9", "/d10", "/d11"]
    with pytest.raises(ValueError):
        expand_path_range("/x/dt=20200[716]/instance")


LINES = "1 1:1 2:0 5:2.5\n\n0 3:4\n  \n1\n"


def test_sparse_text_keeps_zeros_and_skips_blank_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text(LINES)
    rows = read_sparse_text(spark, str(tmp_path / "a.txt")).collect()
    assert [(r["label"], [(e["f"], e["v"]) for e in r["feats"]]) for r in rows] == [
        (1.0, [(0, 1.0), (1, 0.0), (4, 2.5)]), (0.0, [(2, 4.0)]), (1.0, [])]


def test_libsvm_reads_several_paths_in_one_scan(spark, tmp_path):
    for name in ("p1", "p2"):
        (tmp_path / name).write_text("1 1:1 4:2\n0 2:3\n")
    df = read_libsvm(spark, f"{tmp_path}/p[1-2]")
    assert df.count() == 4
    assert df.first()["features"].size == 4
    assert df._jdf.queryExecution().toString().count("FileScan libsvm") == 1
    listed = read_libsvm(spark, [f"{tmp_path}/p1", f"{tmp_path}/p2"], num_features=10)
    assert listed.first()["features"].size == 10


def test_write_libsvm_round_trip(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1.0, [(0, 1.5), (7, 0.0)]), (0.0, [])], "label double, feats array<struct<f:int,v:double>>")
    write_libsvm(rows, str(tmp_path / "out"))
    assert read_sparse_text(spark, str(tmp_path / "out")).exceptAll(rows).count() == 0


def test_dense_and_typed_csv(spark, tmp_path):
    (tmp_path / "d.csv").write_text("1,2,0\n3,,1\n")
    rows = read_labelled_csv(spark, str(tmp_path / "d.csv")).collect()
    assert [r["label"] for r in rows] == [0.0, 1.0] and rows[0]["features"].toArray().tolist() == [1.0, 2.0]
    (tmp_path / "t.csv").write_text("a,1.5,x\n")
    typed = read_typed_csv(spark, str(tmp_path / "t.csv"), "index string, w double, class string")
    assert typed.columns == ["w", "class"] and typed.first()["w"] == 1.5


def test_day_range_prunes_partitions(spark, tmp_path):
    days = spark.range(10).select(F.col("id"), (F.lit(20200710) + F.col("id")).cast("int").alias("dt"))
    days.write.partitionBy("dt").parquet(str(tmp_path / "log"))
    picked = read_day_range(spark, str(tmp_path / "log"), 20200713, 20200715)
    assert sorted(r["dt"] for r in picked.collect()) == [20200713, 20200714, 20200715]
    assert "PartitionFilters: [isnotnull(dt" in picked._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        read_day_range(spark, str(tmp_path / "log"), 20200716, 20200715)


SPEC = """
# continuous
name=rate;class=S_direct;slot=101;depend=rate;is_hash=false;feat_type=0

name=flag;class=S_onehot;slot=201;depend=flag;is_hash=false;feat_values=0,1,2
name=single;class=S_onehot;slot=202;depend=single;is_hash=false;feat_values=x
# name=off;class=S_onehot;slot=301;depend=off;is_hash=true;hash_range_max=1000
"""


@pytest.mark.parametrize("expand, last", [(True, "single=x"), (False, "single")])
def test_feature_map(spark, tmp_path, expand, last):
    (tmp_path / "spec").write_text(SPEC)
    rows = feature_map(read_spec(spark, str(tmp_path / "spec")), expand).orderBy("feature_id").collect()
    assert [tuple(r) for r in rows] == [
        (0, "rate", "q"), (1, "flag=0", "i"), (2, "flag=1", "i"), (3, "flag=2", "i"), (4, last, "i")]


def test_spec_hash_settings(spark):
    line = "name=app;class=S_onehot;slot=301;depend=app;is_hash=true;hash_range_max=1000"
    row = parse_spec(spark.createDataFrame([(0, line)], "line int, text string")).first()
    assert (row["is_hash"], row["hash_min"], row["hash_max"]) == (True, 0, 1000)


def test_linear_model_round_trip(spark, tmp_path):
    (tmp_path / "t").write_text("\n".join(f"{i % 2} 1:{i} 3:{i % 5}" for i in range(60)))
    df = read_libsvm(spark, str(tmp_path / "t"))
    model = logistic_regression(20, 0.01, 0.5).fit(df)
    write_linear_model(spark, model, str(tmp_path / "lr"))
    rows = df.withColumn("feats", feats_from_vector("features"))
    ours = linear_score(rows, read_linear_model(spark, str(tmp_path / "lr"))).select(F.round("probability", 9).alias("p"))
    from pyspark.ml.functions import vector_to_array

    theirs = model.transform(df).select(F.round(vector_to_array("probability")[1], 9).alias("p"))
    assert same_predictions(ours, theirs).count() == 0
