"""Operators for training-data pipelines: search, archives, deduplication, classifiers, scans."""
