"""Compare a registered query with its SQL on DuckDB: names, types, rows and values."""

from __future__ import annotations

import sys
import time

import duckdb
import pyarrow as pa

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(t: pa.DataType) -> str:
    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_string(t) or pa.types.is_large_string(t) or str(t) == "string_view":
        return "string"
    return str(t)


def _rows(table: pa.Table) -> list[tuple]:
    columns = [table.column(c).to_pylist() for c in sorted(table.column_names)]
    return sorted(zip(*columns), key=repr)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    got = spark_df.toArrow()
    want = con.execute(sql).to_arrow_table()
    types = [
        {c: _plain(t.schema.field(c).type) for c in sorted(t.column_names)} for t in (got, want)
    ]
    if types[0] != types[1]:
        return f"schema {types[0]} != {types[1]}"
    if got.num_rows != want.num_rows:
        return f"rows {got.num_rows} != {want.num_rows}"
    for a, b in zip(_rows(got), _rows(want)):
        if repr(a) != repr(b):
            return f"value {a} != {b}"
    return None


if __name__ == "__main__":
    import pathlib

    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
    import __spark_entry__ as contract
    from medalake.session import local_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    sql = contract.oracle_sql()
    bad = 0
    for name, fn in contract.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = difference(fn(spark, sf_dir), con, sql[name]) if name in sql else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem = f"error {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("differences:", bad)
