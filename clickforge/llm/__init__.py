"""Operators for training-data corpora: dedup, decontamination, filters, extraction, tokenisation."""
