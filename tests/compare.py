"""Run registered queries and their SQL on one folder and compare whole results.

    python tests/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def canonical(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def difference(spark, connection, name: str, sf_dir: str) -> str:
    """Empty when both results are the same multiset of rows under the same column names."""
    from salesmart.oracles import ORACLES
    from salesmart.registry import QUERIES

    frame = QUERIES[name](spark, sf_dir)
    ours = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    theirs = canonical(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if ours == theirs:
        return "" if ours else "no rows"
    extra, missing = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; "
        f"{sum(extra.values())} differ, such as {next(iter(extra), None)} against {next(iter(missing), None)}"
    )


if __name__ == "__main__":
    from salesmart.registry import QUERIES
    from salesmart.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    session = build_session(
        "compare", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    tables = connect(folder)
    for key in wanted or QUERIES:
        started = time.time()
        try:
            verdict = difference(session, tables, key, folder) or "same"
        except Exception as error:  # report every query
            verdict = f"ERROR {type(error).__name__} {str(error)[:1500]}"
        print(f"\n{key:22} {time.time() - started:6.1f}s  {verdict}", flush=True)
