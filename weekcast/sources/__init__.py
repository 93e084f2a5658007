"""Readers for the given tables, the standing inputs derived from them, and sinks."""

from weekcast.sources.tables import read_table
from weekcast.sources.inputs import (
    weekly, sparse, devrows, listing, runlog, data_calendar_bounds,
)

__all__ = ["read_table", "weekly", "sparse", "devrows", "listing", "runlog",
           "data_calendar_bounds"]
