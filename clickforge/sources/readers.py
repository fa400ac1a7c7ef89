"""Log readers. Every reader is one scan, however many paths it is given."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PathSpec = str | Sequence[str]


def expand_path_range(path: str) -> list[str]:
    """Expand the first ``[lo-hi]`` of a path, both ends included and without zero padding."""
    bracket = re.search(r"\[([^\]]*)\]", path)
    if bracket is None:
        return [path]
    ends = re.fullmatch(r"(\d+)-(\d+)", bracket.group(1))
    if ends is None:
        raise ValueError(f"expected [lo-hi] in {path!r}")
    head, tail = path[: bracket.start()], path[bracket.end():]
    return [f"{head}{i}{tail}" for i in range(int(ends.group(1)), int(ends.group(2)) + 1)]


def _paths(paths: PathSpec) -> list[str]:
    listed = paths.split(",") if isinstance(paths, str) else list(paths)
    expanded = [one for path in listed for one in expand_path_range(path.strip())]
    if not expanded:
        raise ValueError("no input path")
    return expanded


def read_libsvm(spark: SparkSession, paths: PathSpec, num_features: int | None = None) -> DataFrame:
    """``(label, features vector)`` of all paths. Pass ``num_features`` to save a scan.

    The format drops explicit zeros; use :func:`read_sparse_text` where zero and missing differ.
    """
    files = _paths(paths)
    if num_features is None:
        widest = F.max(F.transform(F.col("feats"), lambda s: s["f"])[F.size("feats") - 1])
        rows = read_sparse_text(spark, files).filter(F.size("feats") > 0)
        num_features = (rows.agg(widest.alias("f")).first()["f"] or 0) + 1
    return spark.read.format("libsvm").option("numFeatures", num_features).load(files)


def read_sparse_text(spark: SparkSession, paths: PathSpec, index_base: int = 1) -> DataFrame:
    """``(label, feats array<struct<f,v>>)`` from ``label id:value ...`` lines.

    Keeps explicit zeros, skips blank lines and shifts ids so that they start at 0; an id below ``index_base`` is an error.
    """
    tokens = F.split(F.trim(F.col("value")), r"\s+")

    def entry(token):
        pair = F.split(token, ":")
        shifted = pair[0].cast("int") - index_base
        checked = F.when(shifted < 0, F.raise_error(F.concat(F.lit("feature id below the base: "), token)).cast("int")).otherwise(shifted)
        return F.struct(checked.alias("f"), pair[1].cast("double").alias("v"))

    return (
        spark.read.text(_paths(paths))
        .filter(F.trim("value") != "")
        .select(tokens.alias("t"))
        .select(
            F.col("t")[0].cast("double").alias("label"),
            F.sort_array(F.transform(F.slice("t", 2, F.size("t") - 1), entry)).alias("feats"),
        )
    )


def read_labelled_csv(spark: SparkSession, path: PathSpec, num_columns: int | None = None,
                      label_last: bool = True) -> DataFrame:
    """``(label, features vector)`` from a dense numeric CSV without header; a row of another width or a bad number is an error."""
    files = _paths(path)
    if num_columns is None:
        num_columns = len(spark.read.text(files).filter(F.trim("value") != "").first()["value"].split(","))
    names = [f"c{i}" for i in range(num_columns)]
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    label = names[-1] if label_last else names[0]
    inputs = [n for n in names if n != label]
    rows = spark.read.schema(schema).option("mode", "FAILFAST").csv(files)
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
    return assembler.transform(rows).select(F.col(label).alias("label"), "features")


def read_typed_csv(spark: SparkSession, path: PathSpec, schema: T.StructType | str,
                   drop: Sequence[str] = ("index",)) -> DataFrame:
    """CSV with a declared schema, without its id columns; a row that does not fit the schema is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").csv(_paths(path)).drop(*drop)


def read_day_range(spark: SparkSession, base: str, low, high, partition: str = "dt",
                   format: str = "parquet") -> DataFrame:
    """Partitions ``low..high`` inclusive of a table laid out by day; others are not opened."""
    if low > high:
        raise ValueError(f"empty day range {low}..{high}")
    table = spark.read.format(format).load(base)
    if partition not in table.columns:
        raise ValueError(f"{base!r} has no partition column {partition!r}")
    return table.filter(F.col(partition).between(low, high))


def read_sql(spark: SparkSession, query: str) -> DataFrame:
    """Result of a query over catalog tables and views."""
    return spark.sql(query)
