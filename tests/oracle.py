"""Run a query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    return tuple(value) if isinstance(value, list) else value


def _kind(dtype: pa.DataType) -> str:
    if pa.types.is_list(dtype) or pa.types.is_large_list(dtype):
        return f"list of {_kind(dtype.value_type)}"
    return str(dtype).removeprefix("large_")


def rows_of(table: pa.Table) -> tuple[list[str], list[str], list[tuple]]:
    """Column names in order of name, their types, and the rows sorted."""
    columns = sorted(table.column_names)
    table = table.select(columns)
    rows = zip(*(map(_plain, table.column(c).to_pylist()) for c in columns))
    return columns, [_kind(t) for t in table.schema.types], sorted(rows)


def compare(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Assert equality; the number of rows."""
    names, types, rows = rows_of(frame.toArrow())
    sql_names, sql_types, sql_rows = rows_of(connection.sql(sql).to_arrow_table())
    assert names == sql_names
    assert types == sql_types
    assert len(rows) == len(sql_rows)
    different = [(a, b) for a, b in zip(rows, sql_rows) if a != b]
    assert not different, (len(different), different[:3])
    return len(rows)
