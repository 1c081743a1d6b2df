"""bazaar — commerce and delivery analytics as lazy Spark DataFrame operators.

Layout:
  sources/    typed table scans, driver-table bindings, document seeds, payload parsing, sinks
  functions/  column-expression helpers (boundary date diffs, NULL-safe concat, exact averages)
  operators/  reusable operators: windows, grouping, hierarchy, documents, geo, text, quality,
              normalisation, upsert, search/paging
  plans/      named end products (views V*, queries X*, document pipelines M*q, batch jobs R*)
              and the catalog that binds them to the driver tables
  streaming/  Structured Streaming forms of the time-driven rules (event retention)

Every operator is ``f(*dataframes, as_of=..., **params) -> DataFrame``: lazy, column expressions
only, no Python UDF, no wall clock.
"""

__version__ = "0.1.0"
