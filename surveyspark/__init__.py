"""Spark-native engine for geotagged field-survey tables.

Subpackages
-----------
functions  column expressions (grid cells, softmax, percent text, URL/path helpers, tests statistics)
operators  DataFrame -> DataFrame steps (merge, dedupe, spatial blocking, folds, audit,
           versioning, scoring, decisions, reports, evaluation, tuning, ingest, work log)
sources    readers and sinks (manifest CSV, occurrence TSV/JSON, image trees, prediction store)
plans      fixture views shared with the SQL oracles and the query registry
streaming  Structured Streaming scoring job
"""

__version__ = "0.1.0"
