"""rxlake — drug-safety and supply analytics as Spark DataFrame plans.

Subpackages
-----------
sources    feed readers (CSV under declared schemas, zones, alert JSON) and
           the adapters that shape the driver's TPC-H-like tables into feeds
functions  Column-expression builders (month keys, guarded ratios, triage rule)
operators  DataFrame -> DataFrame operators (clean, curate, marts, quality,
           series, severity, KPIs)
streaming  Structured Streaming triage
sinks      zone / table / model writers
plans      the daily job and the named query catalog
"""

__version__ = "0.1.0"
