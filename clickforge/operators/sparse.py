"""Sparse rows: ``feats array<struct<f:int, v:double>>`` where an absent id means *missing*.

Unlike an MLlib vector this form can hold a present zero, which trees treat differently
from a missing value.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

FEATS_TYPE = "array<struct<f:int,v:double>>"


def feats_from_columns(columns: Sequence[str | Column]) -> Column:
    """Ids 0..n-1 in column order; null columns are missing."""
    columns = [F.col(c) if isinstance(c, str) else c for c in columns]
    entries = [F.struct(F.lit(i).alias("f"), c.cast("double").alias("v")) for i, c in enumerate(columns)]
    return F.filter(F.array(*entries), lambda s: s["v"].isNotNull())


def feats_from_map(column: str | Column) -> Column:
    return F.sort_array(
        F.transform(F.map_entries(column), lambda e: F.struct(
            e["key"].cast("int").alias("f"), e["value"].cast("double").alias("v")))
    )


def feats_from_vector(column: str | Column) -> Column:
    """Stored entries of a sparse vector, every entry of a dense one."""
    raw = F.unwrap_udt(column)
    stored = F.transform(
        F.arrays_zip(raw["indices"], raw["values"]),
        lambda e: F.struct(e["indices"].alias("f"), e["values"].alias("v")),
    )
    dense = F.transform(raw["values"], lambda x, i: F.struct(i.cast("int").alias("f"), x.alias("v")))
    return F.when(raw["type"] == 0, stored).otherwise(dense)


def feats_column(df: DataFrame, features: str | Sequence[str]) -> Column:
    """Sparse-row form of whatever holds the features: a vector, map, feats or list of columns."""
    if not isinstance(features, str):
        return feats_from_columns(features)
    kind = df.schema[features].dataType
    if isinstance(kind, VectorUDT):
        return feats_from_vector(features)
    if isinstance(kind, T.MapType):
        return feats_from_map(features)
    return F.col(features)


def entry_rows(df: DataFrame, feats: str | Column = "feats", keys: Sequence[str] = ()) -> DataFrame:
    """Long form ``(keys, f, v)`` of sparse rows.

    The outer generator is deliberate: for the plain one the optimizer adds a filter on the array's
    size and pushes it to the scan, where the whole expression behind the array runs once more.
    """
    entries = df.select(*keys, F.inline_outer(feats))
    return entries.filter(F.col("f").isNotNull())


def element_rows(df: DataFrame, array: str | Column, names: tuple[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """Long form ``(keys, position, element)`` of an array; see :func:`entry_rows` on the generator."""
    elements = df.select(*keys, F.posexplode_outer(array).alias(*names))
    return elements.filter(F.col(names[0]).isNotNull())


def feats_to_vector(feats: str | Column, size: int) -> Column:
    """Sparse MLlib vector of the given size; an id outside ``[0, size)`` is an error."""

    @arrow_udf(VectorUDT())
    def assemble(rows: pa.Array) -> pa.Array:
        entries = rows.flatten()
        ids = entries.field("f").to_numpy(zero_copy_only=False)
        values = entries.field("v").to_numpy(zero_copy_only=False)
        owner = list_owner(rows)
        if len(ids) and (ids.min() < 0 or ids.max() >= size):
            raise ValueError(f"feature id {ids.min() if ids.min() < 0 else ids.max()} outside [0, {size})")
        offsets = list_offsets(owner, len(rows))
        return pa.StructArray.from_arrays(
            [
                pa.array(np.zeros(len(rows), np.int8)),
                pa.array(np.full(len(rows), size, np.int32)),
                pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(values)),
            ],
            names=["type", "size", "indices", "values"],
        )

    return assemble(feats)


def list_owner(rows: pa.ListArray) -> np.ndarray:
    """Row number of every flattened list element."""
    lengths = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(rows)), lengths)


def list_offsets(owner: np.ndarray, n_rows: int) -> pa.Array:
    """Arrow list offsets for elements that are grouped by their row number."""
    counts = np.bincount(owner, minlength=n_rows)
    return pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
