"""meterline: trip-record analytics as plain PySpark DataFrame operators.

Layers:
  functions/  column expressions (durations, keys, rounding, labels, JSON paths)
  sources/    readers and writers (typed Parquet scans, file provenance, CSV
              dimensions, partitioned writes, file ledger)
  operators/  column-parameterised DataFrame operators (clean, enrich, dedupe,
              upsert, aggregates, windows, profiles, checks)
  plans/      the trip models, marts, reports and profiles wired from operators
  streaming/  exactly-once file pick-up feeding the upsert via foreachBatch
"""

__version__ = "0.1.0"
