"""Sinks: table dumps, delimited files, history and dated outputs."""

from .writers import (
    append_history,
    history_union,
    stamp_run,
    write_delimited,
    write_partitioned_by_run_date,
    write_table,
)

__all__ = [
    "append_history",
    "history_union",
    "stamp_run",
    "write_delimited",
    "write_partitioned_by_run_date",
    "write_table",
]
