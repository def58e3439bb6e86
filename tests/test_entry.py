"""The entry module: every query against its DuckDB twin on the smallest tables, and without the training subpackage."""

import glob
import os
import shutil
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    return repr(bytes(v)) if isinstance(v, (bytes, bytearray)) else repr(v)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def catalog():
    from ledgerloom.plans.catalog import ORACLES, QUERIES

    return QUERIES, ORACLES


@pytest.mark.parametrize("name", sorted(catalog()[0]))
def test_query_equals_its_twin(spark, duck, name):
    queries, oracles = catalog()
    df = queries[name](spark, SF)
    names = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*names).collect())
    if name not in oracles:
        assert got
        return
    twin = duck.sql(oracles[name])
    assert sorted(twin.columns) == names
    at = [twin.columns.index(n) for n in names]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in twin.fetchall())


def test_every_oracle_has_a_query():
    queries, oracles = catalog()
    assert set(oracles) <= set(queries)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_works_without_the_training_subpackage(tmp_path):
    """The rest imports, and lists its queries, where the training operators and the pipeline are absent."""
    for name in ("ledgerloom", "__spark_entry__.py"):
        source = os.path.join(HERE, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 50 and not any(q.startswith('op1_') or q == 'pipeline' for q in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
