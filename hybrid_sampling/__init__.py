"""Hybrid-measure systematic sampling on Spark DataFrames.

Sub-packages:
  functions  column expressions (exact integer arithmetic, sort orders)
  operators  DataFrame -> DataFrame steps (request, factors, sizes, eligibility,
             ranking, draw, replacement)
  sources    readers, sinks and request control tables
  plans      the whole job (plans.job), the proxy views over the test tables,
             the registered queries and their DuckDB oracles
  streaming  incremental processing of newly arrived requests

Run the job over stored tables with ``python -m hybrid_sampling --tables ROOT --out ROOT``.
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming"]
