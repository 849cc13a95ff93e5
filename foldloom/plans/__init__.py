"""Corpora as configuration, and the runs over them."""
