"""skerry: a Spark-native analytics engine for metadata and prediction lakes.

Sub-packages
------------
sources    tolerant, schema-normalising scans
functions  pure Column expressions (text, geo, statistics, vectors)
operators  DataFrame -> DataFrame transforms (dedup, membership, graph, ranking)
plans      whole queries, each with its SQL oracle, grouped by subject
streaming  Structured Streaming counterparts
"""
