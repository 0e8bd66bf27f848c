"""Loads every query module, which fills the registry."""

from caseflow.plans import (  # noqa: F401
    event_queries,
    ingest_queries,
    io_queries,
    model_queries,
    panel_queries,
    quality_queries,
    structure_queries,
)
from caseflow.plans.registry import ORACLES, QUERIES  # noqa: F401
