"""Column metadata: what a column holds, kept in the schema itself."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# Kind and description of each column.
MUNICIPALITY_COLUMNS = {
    "codigo_ibge": (
        "NUMERICO",
        "Código composto de 7 dígitos, sendo os dois primeiros referentes ao código da Unidade da Federação",
    ),
    "nome": ("TEXTO", "Nome do município"),
    "latitude": ("NUMERICO", "Latitude do município"),
    "longitude": ("NUMERICO", "Longitude do município"),
    "e_capital": ("BOOLEANO", "Identifica se o município é ou não capital do estado"),
    "uf": ("TEXTO", "Unidade Federativa que identifica o estado"),
    "nome_estado": ("TEXTO", "Nome do estado"),
    "regiao": ("TEXTO", "Agrupamento das UFs"),
    "gerado_em": ("DATA E HORA", "Identifica a data e hora que o registro foi gerado pela orquestração"),
}

# Kind and description of each column.
WEATHER_COLUMNS = {
    "codigo_ibge": (
        "NUMERICO",
        "Código composto de 7 dígitos, sendo os dois primeiros referentes ao código da Unidade da Federação",
    ),
    "data_hora": ("DATA E HORA", "Data e hora dos dados meteorológicos"),
    "humidade_relativa": ("NUMERICO", "Umidade relativa a 2 metros acima do solo"),
    "unidade_humidade_relativa": ("TEXTO", "Unidade de medida da umidade relativa"),
    "temperatura": ("NUMERICO", "Temperatura do ar a 2 metros acima do solo"),
    "unidade_temperatura": ("TEXTO", "Unidade de medida da temperatura do ar"),
    "velocidade_do_vento": ("NUMERICO", "Velocidade do vento a 10 metros acima do solo"),
    "unidade_velocidade_do_vento": ("TEXTO", "Unidade de medida da velocidade do vento"),
    "elevacao": (
        "NUMERICO",
        "A elevação usada para redução de escala estatística. "
        "Por padrão, um modelo de elevação digital de 90 metros é usado",
    ),
    "latitude": ("NUMERICO", "Latitude do município"),
    "longitude": ("NUMERICO", "Longitude do município"),
    "fuso_horario": ("TEXTO", "Fuso horário considerado para o campo time"),
    "abreviacao_fuso_horario": ("TEXTO", "Abreviação do fuso horário"),
    "deslocamento_fuso_horario_em_segundos": ("NUMERICO", "Deslocamento do fuso horário em segundos"),
    "gerado_em": ("DATA E HORA", "Identifica a data e hora que o registro foi gerado pela orquestração"),
}


def annotate(df: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Attach ``{tipo, descricao}`` to the columns of ``df`` that ``columns`` describes."""
    for name in df.columns:
        if name in columns:
            kind, description = columns[name]
            df = df.withMetadata(name, {"tipo": kind, "descricao": description})
    return df


def dictionary(df: DataFrame) -> DataFrame:
    """The data dictionary of ``df``: one row ``(coluna, tipo, descricao)`` per described column."""
    rows = [
        (f.name, f.metadata["tipo"], f.metadata["descricao"])
        for f in df.schema
        if {"tipo", "descricao"} <= f.metadata.keys()
    ]
    return df.sparkSession.createDataFrame(rows, "coluna STRING, tipo STRING, descricao STRING")


def require_annotations(df: DataFrame) -> DataFrame:
    """Return ``df`` if every column is described, else raise ``ValueError``."""
    bare = [f.name for f in df.schema if not {"tipo", "descricao"} <= f.metadata.keys()]
    if bare:
        raise ValueError(f"columns without a description: {bare}")
    return df
