"""Run a query and its SQL side by side and compare names, types and the whole multiset of rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

DUCK_TYPES = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def differences(df, con, sql: str) -> list[str]:
    """What is wrong with ``df``, by the SQL; empty if all is equal."""
    described = {r[0]: DUCK_TYPES.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    if have != described:
        return [f"columns {sorted(have.items())} for {sorted(described.items())}"]
    columns = sorted(have)
    found = Counter(tuple(row) for row in df.select(*columns).collect())
    quoted = ", ".join(f'"{c}"' for c in columns)
    wanted = Counter(con.execute(f"SELECT {quoted} FROM ({sql}) AS q").fetchall())
    extra, lacking = found - wanted, wanted - found
    if not wanted:
        return ["the SQL gives no rows"]
    if extra or lacking:
        return [
            f"{found.total()} rows for {wanted.total()}, {extra.total()} extra, {lacking.total()} lacking; "
            f"e.g. {columns} {next(iter(extra), None)} / {next(iter(lacking), None)}"
        ]
    return []
