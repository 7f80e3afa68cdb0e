"""Run registered queries beside their SQL in DuckDB and compare whole results.

    python -m checks.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from checks import queries, sql


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _ordered(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """None when both hold the same rows, else what differs first."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    try:
        pd.testing.assert_frame_equal(_ordered(ours), _ordered(theirs), check_exact=True)
    except AssertionError as problem:
        return str(problem)
    return None


def main(sf_dir: str, names: list[str]) -> int:
    from tidewater.session import build_session

    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    statements = sql.registered()
    failed = 0
    for name, query in queries.registered().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            ours = query(spark, sf_dir).toPandas()
            took = time.time() - start
            problem = difference(ours, con.execute(statements[name]).df())
        except Exception as error:  # report and go on with the next query
            took, ours, problem = time.time() - start, [], f"{type(error).__name__}: {error}"
        failed += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:32} {len(ours):7} rows {took:6.2f}s", flush=True)
        if problem:
            print("    " + problem[:1500].replace("\n", "\n    "), flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
