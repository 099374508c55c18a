"""Column helpers: periods, load stamp, column metadata."""

from chuvisco.functions.metadata import annotate, dictionary, require_annotations
from chuvisco.functions.periods import (
    month_bounds,
    period_path,
    reference_date,
    year_bounds,
)
from chuvisco.functions.stamp import stamp

__all__ = [
    "annotate",
    "dictionary",
    "month_bounds",
    "period_path",
    "reference_date",
    "require_annotations",
    "stamp",
    "year_bounds",
]
