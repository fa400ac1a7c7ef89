"""Readers and writers."""

from clickforge.sources.readers import (
    expand_path_range,
    read_day_range,
    read_labelled_csv,
    read_libsvm,
    read_sparse_text,
    read_sql,
    read_typed_csv,
)
from clickforge.sources.writers import (
    read_linear_model,
    write_importance_csv,
    write_libsvm,
    write_linear_model,
)

__all__ = [
    "expand_path_range", "read_day_range", "read_labelled_csv", "read_libsvm", "read_linear_model",
    "read_sparse_text", "read_sql", "read_typed_csv", "write_importance_csv", "write_libsvm",
    "write_linear_model",
]
