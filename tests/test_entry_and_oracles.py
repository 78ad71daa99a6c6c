"""Driver contract: entry() runs, every query has an oracle and matches it
(row count, names and values) on the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, rows_of


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "n_obs" in df.columns


def test_every_query_has_an_oracle():
    from tidewater.plans.registry import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF_SMALL}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)
    spark.catalog.clearCache()


def test_runs_from_another_directory(tmp_path):
    """Workers must not need this repository on their import path: the
    driver may load __spark_entry__.py from anywhere."""
    import subprocess
    import sys

    script = tmp_path / "run.py"
    script.write_text(
        "import importlib.util\n"
        f"spec = importlib.util.spec_from_file_location('se', {os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), '__spark_entry__.py')!r})\n"
        "E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "print('ROWS', E.entry(s).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
    assert int(out.stdout.split("ROWS")[1].split()[0]) > 0
