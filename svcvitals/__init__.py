"""svcvitals: service-health analytics as Spark DataFrame operators.

Layers:
  functions/  Column helpers (classifiers, JSON scalars, rounding, score pieces)
  operators/  DataFrame -> DataFrame operators (metrics, events, logs, survey, scores, legacy)
  sources/    readers/writers (raw tables, survey sheet) and test-data adapters
  streaming/  Structured Streaming ingestion (event envelopes, log routing)
  plans/      composed plans: the view stack, registered queries, oracle SQL
"""

__version__ = "0.1.0"
