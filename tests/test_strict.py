"""Nothing is dropped in silence: foreign ids, broken rows and negative ids are errors; draws with other salts are independent."""

import pytest
from pyspark.sql import functions as F

from clickforge.operators.linear import linear_score
from clickforge.operators.sparse import feats_to_vector
from clickforge.operators.splits import k_fold, key_split, mix_key
from clickforge.plans import views
from clickforge.sources.readers import read_labelled_csv, read_sparse_text

FEATS = "array<struct<f:int,v:double>>"


def test_foreign_ids_are_errors(spark):
    rows = spark.createDataFrame([([(0, 1.0), (7, 5.0)],)], f"feats {FEATS}")
    assert rows.select(feats_to_vector("feats", 8).alias("x")).first().x.size == 8
    with pytest.raises(Exception, match="outside"):
        rows.select(feats_to_vector("feats", 5).alias("x")).collect()


def test_negative_ids_are_errors(spark, tmp_path):
    weights = spark.createDataFrame([(-1, 1.0), (0, 20.0)], "index int, weight double")
    rows = spark.createDataFrame([([(-1, 1.0)],)], f"feats {FEATS}")
    with pytest.raises(Exception, match="below 0"):
        linear_score(rows, weights).collect()
    (tmp_path / "s.txt").write_text("1 0:1.0 2:3.0\n")
    with pytest.raises(Exception, match="below the base"):
        read_sparse_text(spark, str(tmp_path / "s.txt"), index_base=1).collect()


@pytest.mark.parametrize("row", ["1,2,3,4", "1,x,3", "1,2"])
def test_broken_csv_rows_are_errors(spark, tmp_path, row):
    (tmp_path / "d.csv").write_text(f"1,2,3\n{row}\n")
    with pytest.raises(Exception):
        read_labelled_csv(spark, str(tmp_path / "d.csv")).collect()


def test_noise_is_independent_of_split_and_fold(spark, sf):
    rows = spark.range(20_000).select(
        (mix_key("id", salt=1) < 214_748_364).cast("int").alias("noise"), key_split("id", [0.8, 0.2], ["train", "test"]).alias("split"),
        k_fold("id", 5, salt=2).alias("fold"))
    shares = rows.groupBy("split", "fold").agg(F.avg("noise").alias("share"), F.count("*").alias("n")).collect()
    assert len(shares) == 10 and all(abs(r.share - 0.1) < 0.03 and r.n > 500 for r in shares)
    assert "noise" not in views.impressions(spark, sf).columns
