"""aurum: customer identity resolution and golden records on Spark.

Everything is DataFrame / SQL / Structured Streaming code. Rule sets are
declarative tables in :mod:`aurum.rules`; the operators live in
:mod:`aurum.operators`, the layered pipelines in :mod:`aurum.plans`.
"""

__version__ = "0.1.0"
