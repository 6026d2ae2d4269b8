"""The driver contract: entry smoke run and Spark-vs-DuckDB agreement of every query."""

import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from stationspark.plans import oracle, registry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.01"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["State", "month", "metric", "value", "unit"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.ORACLE)
    assert set(oracle.ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_optional_operators():
    """The other queries stay when the optional subpackage and pipeline are gone."""
    code = ("import sys, importlib.abc\n"
            "class Gone(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('corpus_pipeline', 'stationspark.llm'):\n"
            "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert set(e.queries()) == set(e.oracle_sql()) and len(e.queries()) >= 38\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=300)


def test_plain_session_without_a_checkpoint_folder(tmp_path):
    """The command line and a scan that writes first, with no Spark configuration at all."""
    conf = tmp_path / "conf"
    conf.mkdir()
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "from stationspark.__main__ import main\n"
            "assert main(['--data', '/root/testdata/sf0.001', '--layout', 'fixtures', 'stations', 'NATION_3']) == 0\n"
            "import __spark_entry__ as e\n"
            "from pyspark.sql import SparkSession\n"
            "spark = SparkSession.getActiveSession()\n"
            "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
            "assert e.queries()['scan_csv_comma'](spark, '/root/testdata/sf0.001').count() > 0\n")
    env = dict(os.environ, SPARK_CONF_DIR=str(conf))
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=600)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _canon(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = lambda v: "NaN" if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(norm(r[i]) for i in order) for r in records), key=repr)


SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = df.collect()
    rel = duck.sql(entry.oracle_sql()[name])
    assert {c: SQL_TYPES.get(t, t) for c, t in df.dtypes} == \
        {c: str(t) for c, t in zip(rel.columns, rel.types)}
    res = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _canon(df.columns, got) == _canon(cols, want)
