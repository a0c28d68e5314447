"""Sources: the driver fixture binding, production readers and fixed dimensions."""

from .dims import dim_demand, dim_recency, http_codes
from .fixtures import FixtureTables
from .readers import (
    employees_from_source,
    invoices_from_source,
    jdbc_query,
    jdbc_table,
    orgs_from_text,
    read_delimited_text,
    read_history,
    read_http_codes,
    read_orgs_snapshot,
    read_segment_dims,
)

__all__ = [
    "FixtureTables",
    "dim_demand",
    "dim_recency",
    "employees_from_source",
    "http_codes",
    "invoices_from_source",
    "jdbc_query",
    "jdbc_table",
    "orgs_from_text",
    "read_delimited_text",
    "read_history",
    "read_http_codes",
    "read_orgs_snapshot",
    "read_segment_dims",
]
