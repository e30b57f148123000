"""Compare a query with its SQL in DuckDB, column by column."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def plain(value):
    if isinstance(value, (decimal.Decimal, float)):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in data), key=repr)


# Spark's types as DuckDB names them.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}
# Wider numbers of sums and quotients in DuckDB count as the type that they hold.
WIDER = {"HUGEINT": "BIGINT"}


def kind_of(name: str) -> str:
    return "DOUBLE" if name.startswith("DECIMAL") else WIDER.get(name, name)


def compare(df, db: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[tuple], list[tuple]]:
    """Number of rows, and the rows that only one side has. Names, their order and types must be equal."""
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    kinds = [(d[0], kind_of(str(d[1]))) for d in result.description]
    want = rows(names, result.fetchall())
    assert kinds == [(name, TYPES[kind]) for name, kind in df.dtypes], (kinds, df.dtypes)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return len(got), [], []
    got_set, want_set = set(map(repr, got)), set(map(repr, want))
    extra = [r for r in got if repr(r) not in want_set]
    missing = [r for r in want if repr(r) not in got_set]
    return len(got), extra or got[:1], missing or want[:1]
