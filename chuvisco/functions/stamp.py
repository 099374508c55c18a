"""Load stamp."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamp(df: DataFrame, column: str = "gerado_em") -> DataFrame:
    """Add the time of the query, the same in every row.

    It is added last, after any aggregate or distinct, so it never takes part in a shuffle key.
    """
    return df.withColumn(column, F.current_timestamp())
