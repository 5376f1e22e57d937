"""Database diagnostics analytics as Spark DataFrames.

Packages
--------
sources    event files, state snapshots, table sinks
functions  column expressions (typing, text, time, paths)
operators  envelope parsing, shredding by specification, ring buffers, change publishing
plans      the report catalogue
streaming  bounded capture and continuous ingestion
"""
