"""Every registered query of the core against its SQL, on the smallest tables; the others run whole."""

import glob
import math
import os

import pytest

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")


def names():
    from armlode.queries import poses, problems, relational, renders, sequence, solved

    return [(m, n) for m in (sequence, poses, relational, solved, renders, problems) for n in m.QUERIES]


def cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if isinstance(x, bool):
        return str(x)
    return repr(float(x)) if isinstance(x, (int, float)) else repr(x)


@pytest.mark.parametrize("module,name", names(), ids=lambda x: x if isinstance(x, str) else "")
def test_query(spark, module, name):
    df = module.QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(cell(x) for x in r) for r in df.select(cols).collect())
    if name not in module.SQL:
        return
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    res = con.execute(module.SQL[name])
    heads = [d[0] for d in res.description]
    assert sorted(heads) == cols
    want = sorted(tuple(cell(r[heads.index(c)]) for c in cols) for r in res.fetchall())
    assert got == want


def test_entry_imports_without_the_corpus_package(tmp_path):
    """In a copy of the repository without that folder the entry loads every query of the core, and no other."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "armlode", tmp_path / "armlode", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True, env={"PATH": "/usr/bin:/bin"})
    assert int(out.stdout.split()[-1]) == sum(len(m.QUERIES) for m in {m for m, _ in names()})
