"""Compare queries with their SQL: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain_type(dtype: pa.DataType) -> str:
    name = str(dtype).replace("large_", "").replace("string_view", "string")
    return "timestamp" if name.startswith("timestamp") else name


def rows_of(data: pa.Table) -> tuple[list[str], list[str], list[tuple]]:
    names = sorted(data.column_names)
    columns = [data.column(n).to_pylist() for n in names]
    types = [plain_type(data.schema.field(n).type) for n in names]
    rows = sorted(zip(*columns, strict=True), key=repr) if columns else []
    return names, types, rows


def differences(got: pa.Table, expected: pa.Table) -> str | None:
    names, types, rows = rows_of(got)
    want_names, want_types, want_rows = rows_of(expected)
    if names != want_names:
        return f"columns {names} != {want_names}"
    if types != want_types:
        return f"types {types} != {want_types}"
    if len(rows) != len(want_rows):
        return f"{len(rows)} rows != {len(want_rows)}"
    for a, b in zip(rows, want_rows, strict=True):
        if a != b:
            return f"row {a} != {b}"[:600]
    return None


def main(argv: list[str]) -> int:
    import sedimenta as sd

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = sd.build_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, make in entry.queries().items():
        if (wanted and name not in wanted) or name not in entry.oracle_sql():
            continue
        start = time.time()
        try:
            got = make(spark, sf_dir).toArrow()
            expected = con.sql(entry.oracle_sql()[name]).to_arrow_table()
            problem = differences(got, expected)
            count = got.num_rows
        except Exception as error:  # noqa: BLE001
            problem, count = f"{type(error).__name__}: {str(error)[:700]}", 0
        bad += problem is not None
        print(f"{name:40s} {count:8d} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
