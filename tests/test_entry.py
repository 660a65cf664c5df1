"""The driver's contract: every registered query runs, and equals its SQL form in DuckDB."""

import glob
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import ROOT, SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(row):
    return tuple("" if x is None else f"{x:.9g}" if isinstance(x, float) else str(x) for x in row)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    rows = df.select(*columns).collect()
    if name in entry.oracle_sql():
        found = duck.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
        assert sorted(map(plain, rows)) == sorted(map(plain, found))


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_without_the_training_data_operators(tmp_path):
    """The rest imports and registers its queries when that subpackage and the pipeline are gone."""
    shutil.copytree(ROOT / "tilewright", tmp_path / "tilewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not [k for k in q if k.startswith('op1')]; assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
