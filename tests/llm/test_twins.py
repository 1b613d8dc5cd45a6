"""Every query that has an SQL twin against DuckDB, values and types."""

from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR

from millrace.llm.queries import QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for file in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = QUERIES[name].plan(spark, SF_DIR)
    cursor = con.execute(QUERIES[name].sql)
    assert {c: TYPES[k] for c, k in df.dtypes} == {d[0]: str(d[1]) for d in cursor.description}
    names = sorted(df.columns)
    order = [[d[0] for d in cursor.description].index(n) for n in names]
    expected = sorted(tuple(repr(r[i]) for i in order) for r in cursor.fetchall())
    found = sorted(tuple(repr(r[n]) for n in names) for r in df.collect())
    wrong = [(a, b) for a, b in zip(found, expected, strict=True) if a != b]
    assert not wrong, f"{names}: {len(wrong)} of {len(found)}: {wrong[:3]}"
