"""Every registered query against DuckDB; those without SQL must run and keep their schema."""

import os
import subprocess
import sys

import oracle
import pytest

import __spark_entry__ as driver
from valence.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SQL, QUERIES = ORACLES, QUERIES


@pytest.fixture(scope="module")
def db():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, db, name):
    count, extra, missing = oracle.compare(QUERIES[name](spark, FOLDER), db, SQL[name])
    assert not extra and not missing, (extra[:3], missing[:3])
    assert count > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.columns and df.count() > 0


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries()) and set(QUERIES) <= set(driver.queries())


def test_import_opens_no_session_and_no_file_of_spark(tmp_path):
    """The queries can be listed where Spark's jars are hidden and Java is missing."""
    code = """
import builtins, pyspark, pyspark.core.context
def refuse(*args, **kwargs):
    raise RuntimeError("a session was started")
pyspark.core.context.SparkContext.__init__ = refuse
plain = builtins.open
builtins.open = lambda path, *a, **k: refuse() if ".jar" in str(path) or "/jars" in str(path) else plain(path, *a, **k)
pyspark.__file__ = "/nowhere/pyspark/__init__.py"
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
"""
    root = os.path.dirname(os.path.abspath(driver.__file__))
    env = {k: v for k, v in os.environ.items() if k not in ("JAVA_HOME", "SPARK_HOME")} | {"PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[0]) >= len(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() == 1


def test_comparison_sees_a_difference(spark, db):
    df = spark.sql("SELECT CAST(1 AS INT) AS a, 0.5D AS b")
    assert oracle.compare(df, db, "SELECT 1 AS a, 0.5 AS b") == (1, [], [])
    assert oracle.compare(df, db, "SELECT 1 AS a, 0.6 AS b")[1:] == ([(1, 0.5)], [(1, 0.6)])
