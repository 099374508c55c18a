"""Municipality dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chuvisco.functions.stamp import stamp


def build_refined(municipalities: DataFrame, states: DataFrame, stamped: bool = True) -> DataFrame:
    """Municipalities with the name and region of their state, each distinct row once.

    Municipalities of an unknown state drop out. ``e_capital`` is null where the flag is null. The
    join carries no hint: Spark broadcasts the states while their size is under its threshold and
    otherwise sorts and merges, splitting states that hold a large share of the rows.
    """
    states = states.select(
        F.col("codigo_uf"), F.col("uf"), F.col("nome").alias("nome_estado"), F.col("regiao")
    )
    places = municipalities.select(
        "codigo_ibge", "nome", "latitude", "longitude", (F.col("capital") == 1).alias("e_capital"), "codigo_uf"
    )
    refined = places.join(states, "codigo_uf", "inner").drop("codigo_uf").distinct()
    return stamp(refined) if stamped else refined


def build_trusted(refined: DataFrame, stamped: bool = True) -> DataFrame:
    """The dimension without coordinates, newly stamped."""
    trusted = refined.select("codigo_ibge", "nome", "e_capital", "uf", "nome_estado", "regiao")
    return stamp(trusted) if stamped else trusted
