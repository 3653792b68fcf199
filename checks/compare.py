"""Compare registered queries with their SQL counterparts.

    python -m checks.compare <folder of sample tables> [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from checks.oracle import ORACLES
from checks.registry import QUERIES, run_query
from ordermill.session import build_session, use_checkpoint_folder


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _comparable(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def cell(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
            return "NULL"
        if hasattr(x, "strftime"):
            return x.strftime("%Y-%m-%d")
        if isinstance(x, float) or type(x).__name__.startswith("float"):
            return repr(float(x))
        if type(x).__name__ in ("bool", "bool_"):
            return str(bool(x))
        return str(x)

    return sorted(tuple(cell(x) for x in row) for row in frame.astype(object).itertuples(index=False))


def differences(spark, connection, name: str, folder: str) -> list[str]:
    got = run_query(name, spark, folder).toPandas()
    want = connection.execute(ORACLES[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} against {sorted(want.columns)}"]
    left, right = _comparable(got), _comparable(want)
    if left == right:
        return []
    only_left, only_right = sorted(set(left) - set(right))[:3], sorted(set(right) - set(left))[:3]
    return [f"{len(left)} rows against {len(right)}", str(sorted(got.columns)),
            *(f"spark  {r}" for r in only_left), *(f"duckdb {r}" for r in only_right)]


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session("checks", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    use_checkpoint_folder(spark).sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = []
    for name in names:
        started = time.time()
        if name not in ORACLES:
            rows = run_query(name, spark, folder).count()
            print(f"rows  {name} {rows}", flush=True)
            continue
        try:
            found = differences(spark, connection, name, folder)
        except Exception as error:
            found = [str(error)[:1500]]
        print(f"{'FAIL' if found else 'ok  '}  {name} {time.time() - started:.1f}s", flush=True)
        for line in found:
            print("      ", line)
        failed += [name] if found else []
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
