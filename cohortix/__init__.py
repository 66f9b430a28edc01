"""cohortix: experiment and transaction analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    loaders with explicit schemas, fixture adapters, landing-zone ingestion
functions  column-expression helpers (hash draws, JSON scalars, date rules)
operators  the analytic operators (experiments, transactions, enrichments, quality, marts)
plans      the query catalog (key -> DataFrame builder) and its DuckDB oracle SQL
streaming  Structured Streaming twins of the batch operators
"""

from cohortix.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
