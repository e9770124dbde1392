"""Compare every query with its SQL twin in DuckDB.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from listing_lake.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    """Rows in a canonical order, with columns by name and values as text."""

    def text(value) -> str:
        if value is None or value is pd.NaT or value != value:
            return "NULL"
        if isinstance(value, float):
            return repr(round(value, 9))
        if hasattr(value, "isoformat"):
            return value.isoformat()[:10]
        return str(value)

    columns = sorted(frame.columns)
    return sorted(tuple(text(v) for v in row) for row in frame[columns].astype(object).values)


def compare(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str:
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"COLUMNS {sorted(set(spark_rows.columns) ^ set(sql_rows.columns))}"
    if len(spark_rows) != len(sql_rows):
        return f"ROWS {len(spark_rows)} != {len(sql_rows)}"
    ours, theirs = rows_of(spark_rows), rows_of(sql_rows)
    for a, b in zip(ours, theirs):
        if a != b:
            cells = [(c, x, y) for c, x, y in zip(sorted(spark_rows.columns), a, b) if x != y]
            return f"VALUES {cells}"
    return "ok"


def frame_of(df) -> pd.DataFrame:
    """Plain rows: nullable integers would become floats in a pandas column."""
    return pd.DataFrame(df.collect(), columns=df.columns, dtype=object)


def frame_of_sql(con: duckdb.DuckDBPyConnection, sql: str) -> pd.DataFrame:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return pd.DataFrame(result.fetchall(), columns=columns, dtype=object)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            ours = frame_of(query(spark, sf_dir))
            took = time.time() - start
            start = time.time()
            verdict = compare(ours, frame_of_sql(con, sql[name])) if name in sql else "rows only"
            sql_took = time.time() - start
        except Exception as error:  # keep going: one report for all queries
            ours, took, sql_took, verdict = [], time.time() - start, 0, f"ERROR {str(error)[:600]}"
        bad += verdict not in ("ok", "rows only")
        print(f"{name:30} {len(ours):7} rows {took:6.1f}s (sql {sql_took:5.1f}s)  {verdict}", flush=True)
    print(f"{bad} problem(s)")
    return bad


if __name__ == "__main__":
    sys.exit(main())
