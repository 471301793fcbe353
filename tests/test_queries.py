"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

from tidemark.plans.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(data):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{data}/events.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    got = QUERIES[name](spark, data).toPandas()
    assert name in ORACLE
    want = duck.execute(ORACLE[name]).df()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    rows = [sorted(map(tuple, x[columns].astype(str).values.tolist())) for x in (got, want)]
    assert rows[0] == rows[1]


def test_entry(spark, data):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_import_needs_no_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; print(len(e.queries()) - len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-500:]
