"""Jobs: operators, sources and sinks put together."""

from chuvisco.plans.jobs import Lake, backfill, compact, compact_month, refresh_days, refresh_month, run_dimension

__all__ = ["Lake", "backfill", "compact", "compact_month", "refresh_days", "refresh_month", "run_dimension"]
