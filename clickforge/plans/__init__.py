"""Whole jobs: estimators, training jobs, tuning and the registered queries."""
