"""Feature cut points and the binned form of a row.

Cut points are approximate quantiles of the present values of each feature, the smallest value
always among them. A value's bin is the number of cuts at or below it, so bin 0 lies below all
training values and the split "bin < b" is the split "value < cuts[b - 1]".

A row becomes ``codes array<int>``: one code per present feature, numbering (feature, bin) pairs
without gaps. Missing features have no code.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from clickforge.operators.sparse import entry_rows, list_offsets, list_owner

# The driver and every task hold all cut points: 8 bytes each, so at most half a gigabyte.
MAX_CUTS = 64_000_000
# Sketches a task may hold at once; each takes up to half a megabyte.
MAX_SKETCHES = 1024
FALLBACK_KEYS = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"


@dataclass
class Cuts:
    """Cut points of all features, flat. ``start[i]:start[i + 1]`` are those of ``ids[i]``.

    ``input_partitions`` is how many partitions the rows came in.
    """

    ids: np.ndarray
    start: np.ndarray
    values: np.ndarray
    input_partitions: int = 0

    @classmethod
    def from_lists(cls, cuts: dict[int, Sequence[float]], input_partitions: int = 0) -> Cuts:
        ids = np.array(sorted(cuts), np.int64)
        sizes = [len(cuts[int(i)]) for i in ids]
        if sum(sizes) > MAX_CUTS:
            raise ValueError(f"{sum(sizes)} cut points exceed {MAX_CUTS}: lower max_bins or the hash range")
        flat = [np.asarray(cuts[int(i)], np.float64) for i in ids]
        start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return cls(ids, start, np.concatenate(flat) if flat else np.zeros(0), input_partitions)

    @property
    def num_features(self) -> int:
        return len(self.ids)

    @property
    def code_start(self) -> np.ndarray:
        """First code of every feature; a feature with K cuts has the K + 1 bins 0..K."""
        return self.start + np.arange(len(self.start))

    @property
    def num_codes(self) -> int:
        return int(self.code_start[-1])

    def threshold(self, feature: int, bin: int) -> float:
        return float(self.values[self.start[feature] + bin - 1])


def find_cuts(df: DataFrame, feats: Column | str, max_bins: int = 256, accuracy: int | None = None,
              missing: float | None = None) -> Cuts:
    """Quantile cut points per feature over all rows.

    A first aggregation takes the range of every feature. Only features with more than one value
    get a quantile sketch, which is what costs memory; indicators need none. Both aggregations
    combine on the map side, so a feature that is present in every row gathers nowhere.
    """
    spark = df.sparkSession
    entry = entry_rows(df, feats).filter(_present("v", missing))
    ranges = entry.withColumn("part", F.spark_partition_id()).groupBy("f").agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.max("part").alias("part")).collect()
    cuts = {r["f"]: [r["low"]] for r in ranges}
    varying = {r["f"]: r["low"] for r in ranges if r["low"] < r["high"]}
    if varying:
        ranks = F.array(*[F.lit(i / max_bins) for i in range(max_bins)])
        quantiles = F.percentile_approx("v", ranks, accuracy or 20 * max_bins).alias("q")
        ids = spark.createDataFrame([(f,) for f in varying], "f int")
        # One id per feature, as many as the cut table the driver holds anyway.
        sketched = entry.join(F.broadcast(ids), "f").groupBy("f").agg(quantiles)
        with _sketches_in_memory(spark, len(varying)):
            rows = sketched.collect()
        cuts |= {r["f"]: sorted({varying[r["f"]], *r["q"]}) for r in rows}
    return Cuts.from_lists(cuts, max((r["part"] for r in ranges), default=-1) + 1)


@contextmanager
def _sketches_in_memory(spark: SparkSession, groups: int):
    """Let a task keep this many sketches (within reason) before it falls back to sorting."""
    before = spark.conf.get(FALLBACK_KEYS)
    spark.conf.set(FALLBACK_KEYS, str(max(int(before), min(groups, MAX_SKETCHES))))
    try:
        yield
    finally:
        spark.conf.set(FALLBACK_KEYS, before)


def equal_width_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """Equal-width bin 0 .. bins-1 of a value, the ends clamped."""
    position = F.floor((value - low) / (high - low) * bins)
    return F.when(position < 0, 0).when(position >= bins, bins - 1).otherwise(position).cast("int")


def _present(name: str, missing: float | None) -> Column:
    there = F.col(name).isNotNull() & ~F.isnan(name)
    return there if missing is None else there & (F.col(name) != missing)


def bin_codes(feats: Column | str, cuts: Cuts, missing: float | None = None) -> Column:
    """``array<int>`` of (feature, bin) codes; features without cut points are left out."""
    ids, start, values, code_start = cuts.ids, cuts.start, cuts.values, cuts.code_start

    @arrow_udf("array<int>")
    def encode(rows: pa.Array) -> pa.Array:
        entries = rows.flatten()
        f = entries.field("f").to_numpy(zero_copy_only=False).astype(np.int64)
        v = entries.field("v").to_numpy(zero_copy_only=False).astype(np.float64)
        owner = list_owner(rows)
        at = np.minimum(np.searchsorted(ids, f), max(len(ids) - 1, 0))
        keep = ~np.isnan(v) & (ids[at] == f if len(ids) else np.zeros(len(f), bool))
        if missing is not None:
            keep &= v != missing
        at, v, owner = at[keep], v[keep], owner[keep]
        low, high = start[at], start[at + 1]
        while np.any(open_ := low < high):
            middle = np.where(open_, (low + high) // 2, 0)
            above = values[middle] <= v
            low = np.where(open_ & above, middle + 1, low)
            high = np.where(open_ & ~above, middle, high)
        codes = code_start[at] + low - start[at]
        return pa.ListArray.from_arrays(list_offsets(owner, len(rows)), pa.array(codes.astype(np.int32)))

    return encode(feats)
