"""starloom: a Spark-native retail star-schema warehouse and sales-analytics library.

Layers:
  sources/    typed readers for the operational tables, the test-data adapter, staging
  functions/  column-level helpers (exact money, calendar parts, change hashes)
  operators/  DataFrame operators: calendar, SCD1/SCD2, surrogate keys, facts,
              distributed ranking, data-quality checks, the analytical queries
  plans/      end-to-end jobs (build the star, refresh a dimension) and the query registry
  streaming/  micro-batch append of the sales fact (same operator, driven by a stream)
"""

__version__ = "0.1.0"
