import datetime
import math

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickforge import functions as fn


def one(df):
    return df.first()[0]


@pytest.mark.parametrize("p, bits", [(0.5, 1.0), (0.0, 0.0), (1.0, 0.0), (-0.1, 0.0), (1.5, 0.0), (0.25, 0.811278)])
def test_binary_entropy(spark, p, bits):
    assert one(spark.range(1).select(fn.binary_entropy(F.lit(p)))) == pytest.approx(bits, abs=1e-6)


@pytest.mark.parametrize("shape, bend", [
    (fn.linear_shape, lambda x: x), (fn.log_shape, lambda x: math.log(1 + 100 * x)), (fn.sqrt_shape, math.sqrt)])
@pytest.mark.parametrize("rate", [0.0, 0.002, 0.01, 0.1, 0.3, 0.9])
def test_domain_transform(spark, shape, bend, rate):
    unit = (min(max(rate, 0.002), 0.3) - 0.002) / 0.298
    expected = (bend(unit) - bend(0)) / (bend(1) - bend(0))
    assert one(spark.range(1).select(fn.domain_transform(F.lit(rate), shape))) == pytest.approx(expected)


def test_null_rate_stays_null(spark):
    null = F.lit(None).cast("double")
    row = spark.range(1).select(fn.domain_transform(null), fn.bucketize_rate(null, 10)).first()
    assert row[0] is None and row[1] is None


def test_bucketize_top_bin(spark):
    assert one(spark.range(1).select(fn.bucketize_rate(F.lit(0.5), 10))) == 9


def test_epoch_does_not_depend_on_the_session_zone(spark):
    day = F.lit(datetime.date(2018, 8, 20))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert one(spark.range(1).select(fn.epoch_seconds(day))) == 1534694400
            assert one(spark.range(1).select(fn.day_bounds(day)))["stop"] == 1534694400 + 86400
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_day_arithmetic(spark):
    day, late = F.lit(datetime.date(2018, 8, 20)), F.lit(datetime.date(2018, 8, 31))
    row = spark.range(1).select(fn.shift_days(day, -10), fn.shift_days(day, 12),
                                F.size(fn.date_sequence(day, late)), fn.date_sequence(late, day)).first()
    assert row[0] == datetime.date(2018, 8, 10) and row[1] == datetime.date(2018, 9, 1)
    assert row[2] == 12 and row[3] == [datetime.date(2018, 8, 31)]


def test_hash_feature(spark):
    row = spark.range(1).select(fn.hash_feature("priority", F.lit("1-URGENT"), 0, 1000),
                                fn.hash_feature("priority", F.lit("1-URGENT"), 5, 5)).first()
    assert row[0] == 765
    assert row[1] >= 10_000_000


def test_positive_score_of_vector_and_number(spark):
    df = spark.createDataFrame([(Vectors.dense([0.3, 0.7]), 0.7)], ["v", "d"])
    assert list(df.select(fn.positive_score(df, "v"), fn.positive_score(df, "d")).first()) == [0.7, 0.7]
