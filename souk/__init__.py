"""souk: marketplace-listing analytics on Spark DataFrames.

Sub-packages:
  functions  – Column-level parsing/cleaning helpers
  operators  – DataFrame -> DataFrame building blocks (clean, dedup, features,
               labels, statistics, reports)
  sources    – file sources/sinks, payload flatteners, category dimension,
               stand-in inputs built from the test tables
  plans      – stage runners that chain operators into the full pipeline
  streaming  – incremental (Structured Streaming) ingest
"""

__version__ = "0.1.0"
