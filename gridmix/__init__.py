"""gridmix: electricity generation and capacity analytics on Spark.

Subpackages: ``functions`` (reference values, column builders), ``operators``
(models, ingestion, quality checks, reports), ``sources`` (landing,
warehouse, test adapters), ``plans`` (registered queries, oracle SQL, the
model graph) and ``streaming`` (exactly-once bronze append).
"""

__version__ = "0.1.0"
