"""Column functions: everything here stays a JVM expression."""

from clickforge.functions.dates import date_sequence, day_bounds, epoch_seconds, shift_days
from clickforge.functions.scalars import (
    binary_entropy,
    bucketize_rate,
    domain_transform,
    hash_feature,
    linear_shape,
    log_shape,
    mat2gray,
    positive_score,
    predicted_class,
    sigmoid,
    sqrt_shape,
)

__all__ = [
    "binary_entropy", "bucketize_rate", "date_sequence", "day_bounds", "domain_transform",
    "epoch_seconds", "hash_feature", "linear_shape", "log_shape", "mat2gray",
    "positive_score", "predicted_class", "shift_days", "sigmoid", "sqrt_shape",
]
