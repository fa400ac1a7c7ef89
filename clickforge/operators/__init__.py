"""DataFrame operators: sparse rows, features, splits, metrics, trees, boosting, linear models."""
