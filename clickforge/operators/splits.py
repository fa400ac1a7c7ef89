"""Set operations, sampling and data splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The linear congruential mix of row keys.
MIX_FACTOR, MIX_STEP, MIX_RANGE = 1_103_515_245, 12_345, 2_147_483_648


def mix_key(key: str | Column, salt: int = 0) -> Column:
    """Scatter a non-negative key over [0, 2**31); the same in every engine.

    Each ``salt`` swaps the value's halves and mixes once more: draws with different salts are independent of each other.
    """
    key = F.col(key) if isinstance(key, str) else key
    mixed = (F.pmod(key.cast("bigint"), F.lit(MIX_RANGE)) * MIX_FACTOR + MIX_STEP) % MIX_RANGE
    for _ in range(salt):
        mixed = ((F.floor(mixed / 65536) + (mixed % 65536) * 32768) * MIX_FACTOR + MIX_STEP) % MIX_RANGE
    return mixed


def _cut_points(weights: Sequence[float]) -> list[int]:
    total, running, cuts = sum(weights), 0.0, []
    for w in weights[:-1]:
        running += w
        cuts.append(int(running / total * MIX_RANGE))
    return cuts


def key_split(key: str | Column, weights: Sequence[float], names: Sequence[str], salt: int = 0) -> Column:
    """Split name of a row from its key: reproducible under any partitioning."""
    mixed = mix_key(key, salt)
    split = F.lit(names[-1])
    for cut, name in reversed(list(zip(_cut_points(weights), names))):
        split = F.when(mixed < cut, name).otherwise(split)
    return split


def k_fold(key: str | Column, folds: int, salt: int = 0) -> Column:
    """Fold number 0 .. folds-1 of a row from its key; inside a part of ``key_split`` take another salt than there."""
    return F.floor(mix_key(key, salt) * folds / MIX_RANGE).cast("int")


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 123) -> list[DataFrame]:
    """Random split; which rows go where depends on the partitioning of ``df``."""
    return df.randomSplit(list(weights), seed)


def time_split(day: str | Column, train: tuple, test: tuple) -> Column:
    """``train`` or ``test`` by inclusive day ranges, null outside both."""
    day = F.col(day) if isinstance(day, str) else day
    return F.when(day.between(*train), "train").when(day.between(*test), "test")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """Union with duplicates removed once, at the end."""
    return union_all(frames).dropDuplicates()


def concat_tagged(frames: dict[str, DataFrame], tag: str = "split") -> DataFrame:
    """Stack named frames and keep their names in a column."""
    return union_all([df.withColumn(tag, F.lit(name)) for name, df in frames.items()])


def head_per_group(df: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows of each group by a unique key.

    Spark keeps only ``n`` rows per group in each task before the shuffle, so a hot group is small
    by the time it meets.
    """
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(group).orderBy(order)))
    return ranked.filter(F.col("__rank") <= n).drop("__rank")
