"""The query catalog: importing the q_* modules registers every key."""

from __future__ import annotations

from cohortix.plans import q_enrich, q_experiments, q_ingest, q_marts, q_predictions, q_quality, q_runs, q_streaming, q_transactions  # noqa: F401
from cohortix.plans.registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
