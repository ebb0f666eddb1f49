"""Registered queries against their SQL on the smallest tables."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
import __spark_entry__ as entry  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no tables")


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(x for x in entry.oracle_sql() if not x.startswith("op") or x in ("optimal_point", "optimal_detail", "optimal_matrix")))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    want = con.execute(f"SELECT {', '.join(f'{chr(34)}{c}{chr(34)}' for c in columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert got == sorted((tuple(map(plain, r)) for r in want), key=repr) and (got or name == "correct_ambiguous")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
