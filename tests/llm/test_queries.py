"""The corpus queries that have SQL, against it, on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from salesmart.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = connection.execute(ORACLES[name])
    columns = sorted(d[0] for d in result.description)
    places = [[d[0] for d in result.description].index(c) for c in columns]
    wanted = Counter(tuple(row[i] for i in places) for row in result.fetchall())
    found = QUERIES[name](spark, FOLDER)
    assert sorted(found.columns) == columns
    assert Counter(map(tuple, found.select(*columns).collect())) == wanted
