"""Labelled-text corpora on Spark: clean, relabel, dedup, fold, rotate, write, check."""

__version__ = "0.1.0"
