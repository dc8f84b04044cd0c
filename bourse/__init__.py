"""bourse: market-data pipelines expressed as Spark DataFrame plans.

Layers:
  sources/    file, Kafka and rescue readers (bronze)
  functions/  column-level helpers (scalar and aggregate expressions)
  operators/  DataFrame -> DataFrame building blocks (quality, CDC, reshape,
              windows, joins, bars, ranking)
  plans/      published tables (silver and gold) and the registered queries
  streaming/  Structured Streaming runners (append, refresh, keyed upserts)
"""

__version__ = "0.1.0"
