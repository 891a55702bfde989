from __future__ import annotations

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(k for k in entry.oracle_sql() if not k.startswith("p") or not k[1].isdigit() or k.startswith("p1_")))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"create view {f[:-8]} as select * from '{FOLDER}/{f}'")
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    mine = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    found = con.execute(entry.oracle_sql()[name])
    theirs = [d[0] for d in found.description]
    place = sorted(range(len(theirs)), key=lambda i: theirs[i])
    assert columns == sorted(theirs)
    assert mine == sorted(repr(tuple(plain(r[i]) for i in place)) for r in found.fetchall())


def test_core_does_not_need_the_subpackage():
    import subprocess

    code = "import sys; sys.modules['skein.llm'] = None\nimport __spark_entry__ as e\nassert e.queries() and not any(k[0] == 'p' and k[1].isdigit() and not k.startswith('p1_') for k in e.queries())"
    assert subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(entry.__file__), capture_output=True).returncode == 0
