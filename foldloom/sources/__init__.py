"""Scans of raw files and of written pools."""
