"""Operators of a training-data pipeline: search, token files, scans, classifiers, near copies, decontamination, pieces."""
