"""Player-season analytics on Spark.

Layers, each a set of functions from DataFrames to DataFrames:

* ``functions``  – Column builders (names, keys, numbers, JSON, positions, similarity)
* ``sources``    – page corpora, raw season tables, seeds, completeness audits
* ``operators``  – generic relational helpers (one row per group, salted joins, data tests)
* ``plans``      – staging, team and player resolution, dimensions, facts, checks, full build
"""
