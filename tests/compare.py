"""Compare a Spark result with DuckDB's, as unordered sets of rows."""

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def hashable(value):
    return tuple(map(hashable, value)) if isinstance(value, list) else value


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(hashable(row[i]) for i in order) for row in rows)


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = con.sql(sql)
    return rows_of(result.columns, result.fetchall())
