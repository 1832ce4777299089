"""Comparing a Spark result with the SQL result, column by column and row by row."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_cell(v) for v in value) + "]"
    return repr(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_cell(row[i]) for i in order) for row in rows)


SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def spark_types(df):
    return {f.name: SPARK_TYPES.get(f.dataType.simpleString(), "?") for f in df.schema.fields}


def compare(df, connection, sql):
    result = connection.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in result.description}
    duck_names, duck_rows = table(list(duck_types), result.fetchall())
    names, rows = table(df.columns, [tuple(r) for r in df.collect()])
    assert names == duck_names
    assert len(rows) == len(duck_rows), (len(rows), len(duck_rows))
    differing = [(a, b) for a, b in zip(rows, duck_rows) if a != b]
    assert not differing, differing[:3]
    described = {
        r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()
    }
    assert spark_types(df) == described
