"""Plans: the run composition, the named queries and their SQL oracles."""

from .billing_run import BillingRun
from .registry import QUERIES, queries, run_for

__all__ = ["BillingRun", "QUERIES", "queries", "run_for"]
