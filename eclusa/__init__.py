"""Control-table-driven ingestion on Spark."""

from eclusa.errors import IngestionError
from eclusa.operators.routing import route
from eclusa.operators.upsert import upsert
from eclusa.plans.ingest import Options, Outcome, ingest, raise_failures, run_arrivals, run_dataset
from eclusa.sources.control import load_control, lookup

__all__ = [
    "IngestionError",
    "Options",
    "Outcome",
    "ingest",
    "load_control",
    "lookup",
    "raise_failures",
    "route",
    "run_arrivals",
    "run_dataset",
    "upsert",
]
