"""Period sinks: every sink replaces whole periods, so a re-run of a
period gives the same target (idempotent upsert)."""

from weekmart.sinks.base import PeriodSink, fan_out
from weekmart.sinks.table import TableSink

__all__ = ["PeriodSink", "fan_out", "TableSink"]
