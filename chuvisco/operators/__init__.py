"""DataFrame-to-DataFrame operators."""

from chuvisco.operators.daily import align_components, align_documents, align_stacked, daily_parts, daily_rollup, merge_parts, rollup_components
from chuvisco.operators.dimension import build_refined, build_trusted
from chuvisco.operators.documents import distinct_documents, latest_documents, months_of, of_days, with_days
from chuvisco.operators.hourly import (
    component_of,
    components,
    explode_metric,
    explode_time,
    hourly_wide,
    settle_hours,
    stacked_components,
)
from chuvisco.operators.requests import extraction_requests, pending_requests
from chuvisco.operators.upsert import files_holding, merge_upsert, upsert_table

__all__ = [
    "align_components",
    "align_documents",
    "align_stacked",
    "build_refined",
    "build_trusted",
    "component_of",
    "components",
    "daily_parts",
    "daily_rollup",
    "distinct_documents",
    "explode_metric",
    "explode_time",
    "extraction_requests",
    "files_holding",
    "hourly_wide",
    "latest_documents",
    "merge_parts",
    "merge_upsert",
    "months_of",
    "of_days",
    "pending_requests",
    "rollup_components",
    "settle_hours",
    "stacked_components",
    "upsert_table",
    "with_days",
]
