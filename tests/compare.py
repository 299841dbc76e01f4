"""Compare a Spark result with its SQL counterpart, row for row, types included."""

from __future__ import annotations

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def run_sql(sql: str, sf_dir: str) -> pa.Table:
    with duckdb.connect() as con:
        con.execute("SET TimeZone = 'UTC'")
        for name in TABLES:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
        return con.sql(sql).to_arrow_table()


def _rows(table: pa.Table) -> list[str]:
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return sorted(repr(row) for row in zip(*columns))


def _types(table: pa.Table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def assert_same(result: DataFrame, sql: str, sf_dir: str) -> int:
    mine, expected = result.toArrow(), run_sql(sql, sf_dir)
    assert _types(mine) == _types(expected)
    left, right = _rows(mine), _rows(expected)
    assert len(left) == len(right), (len(left), len(right))
    different = [pair for pair in zip(left, right) if pair[0] != pair[1]]
    assert not different, (len(different), different[:3])
    return len(left)
