"""Score, entropy and click-rate shape functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The click-rate window of domain_transform, the soft step of mat2gray and
# the hash range used when a feature does not set its own.
RATE_LOW, RATE_HIGH = 0.002, 0.3
GRAY_OFFSET = 0.01
HASH_RANGE = (0, 10_000_000)

Shape = Callable[[Column], Column]


def sigmoid(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def predicted_class(probability: Column, threshold: float = 0.5) -> Column:
    """1.0 above the threshold, else 0.0."""
    return F.when(probability > threshold, 1.0).otherwise(0.0)


def positive_score(df: DataFrame, column: str) -> Column:
    """Score of the positive class from a 2-vector or from a plain number."""
    if isinstance(df.schema[column].dataType, VectorUDT):
        return F.get(vector_to_array(F.col(column)), F.lit(1))
    return F.col(column).cast("double")


def binary_entropy(p: Column) -> Column:
    """Entropy in bits of a coin with head rate ``p``; 0 outside (0, 1)."""
    inside = (p > 0) & (p < 1)
    safe = F.when(inside, p)
    bits = -safe * F.log2(safe) - (1 - safe) * F.log2(1 - safe)
    return F.when(inside, bits).otherwise(0.0)


def linear_shape(x: Column) -> Column:
    return x


def log_shape(x: Column) -> Column:
    return F.log1p(100.0 * x)


def sqrt_shape(x: Column) -> Column:
    return F.sqrt(x)


def domain_transform(rate: Column, shape: Shape = linear_shape) -> Column:
    """Clamp a rate to its window, stretch the window to [0, 1] and bend it by ``shape``."""
    clamped = F.when(rate < RATE_LOW, RATE_LOW).when(rate > RATE_HIGH, RATE_HIGH).otherwise(rate)
    unit = (clamped - RATE_LOW) / (RATE_HIGH - RATE_LOW)
    at_zero, at_one = shape(F.lit(0.0)), shape(F.lit(1.0))
    return (shape(unit) - at_zero) / (at_one - at_zero)


def mat2gray(x: Column) -> Column:
    return x / (x + GRAY_OFFSET)


def bucketize_rate(rate: Column, bins: int, shape: Shape = linear_shape) -> Column:
    """Equal-width bin (0 .. bins-1) of the transformed rate."""
    position = F.floor(domain_transform(rate, shape) * bins)
    return F.when(position >= bins, bins - 1).otherwise(position).cast("int")


def hash_feature(name: str | Column, value: Column, low: int = HASH_RANGE[0],
                 high: int = HASH_RANGE[1]) -> Column:
    """Hash ``name=value`` into [low, high); an empty range leaves the 32-bit hash as it is."""
    name = F.lit(name) if isinstance(name, str) else name
    digest = F.md5(F.concat(name, F.lit("="), value.cast("string")))
    code = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return code % (high - low) + low if low < high else code
