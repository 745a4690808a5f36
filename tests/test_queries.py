"""Every query that has SQL against DuckDB on the smallest tables; the others must run and keep their columns."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

pytestmark = pytest.mark.skipif(not Path(SMALL).is_dir(), reason="no test tables")
SQL = entry.oracle_sql()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


FOUND = {
    "p1_found": {"jobid"}, "p2_found": {"term", "mark"}, "p3_found": {"jobid", "line_no"}, "p4_found": {"name_a", "name_b"}, "p5_found": {"jobid", "lang"}, "p6_found": {"jobid", "line_no"}, "p7_found": {"jobid", "placeid"},
    "p9_found": {"item_id", "doc_id"}, "p10_found": {"doc_id"},
}


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, name):
    df = entry.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(plain(x) for x in r)) for r in df.select(*columns).collect())
    if name in FOUND:
        assert set(columns) == FOUND[name] and len(set(got)) == len(got)
    if name not in SQL:
        assert got
        return
    con = duckdb.connect()
    for f in Path(SMALL).iterdir():
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    rel = con.execute(SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(plain(r[names.index(c)]) for c in columns)) for r in rel.fetchall())
    assert got == want
