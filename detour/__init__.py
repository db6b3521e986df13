"""detour — transit-disruption analytics expressed as Spark DataFrame plans.

Layout:
  sources/    readers for line-status, station, stop and membership documents,
              broker records, the alert history and the line-id vocabulary
  functions/  column expressions (defaults, naming, timestamps, JSON, geo)
  operators/  DataFrame -> DataFrame building blocks (status reduction, graph
              tables, keyed upserts, radius join, nearest paths, alerts, reports)
  plans/      the registered query catalogue over the driver's tables
  streaming/  the Structured Streaming alert job and its replay-safe sink
"""

from detour.params import Params

__all__ = ["Params"]
