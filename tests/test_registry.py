"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import TABLES
from reviewgrove.functions.tokens import stop_words
from reviewgrove.registry.oracle import STOP_WORDS, oracle
from reviewgrove.registry.queries import REGISTERED

QUERIES = dict(REGISTERED)
SQL = oracle()
# Empty on the smallest tables, where no term of the labelled documents is frequent enough.
LARGER = {"feature_categories", "feature_categories_ml", "feature_values", "feature_values_ml", "forest_stump"}


def connected(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def tables(sf_dir):
    return connected(sf_dir)


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 8) + 0.0
    return value


def _rows(rows):
    return sorted((tuple(map(_plain, row)) for row in rows), key=repr)


def _kind(name):
    """Column types of both engines under one name."""
    name = str(name).lower()
    names = {
        "tinyint": "int", "smallint": "int", "integer": "int", "int": "int", "bigint": "long", "hugeint": "long",
        "varchar": "string", "string": "string", "double": "double", "float": "double", "boolean": "boolean",
        "timestamp": "time", "timestamp_ntz": "time", "timestamp_ns": "time",
    }
    return names.get(name, name)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_stop_words_are_those_of_spark(spark):
    assert STOP_WORDS == stop_words()


def test_sql_is_made_without_a_session_or_files(tmp_path):
    """In a fresh process whose Spark folder has no jars."""
    code = (
        "import sys, types, pathlib, pyspark\n"
        f"pyspark.__file__ = {str(tmp_path / '__init__.py')!r}\n"
        "import __spark_entry__ as e\n"
        "from pyspark.sql import SparkSession\n"
        "assert e.oracle_sql() and SparkSession.getActiveSession() is None\n"
    )
    root = Path(contract.__file__).parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, tables, sf_dir, name):
    if name in LARGER:
        sf_dir = sf_dir.replace("sf0.001", "sf0.01")
        tables = connected(sf_dir)
    df = QUERIES[name](spark, sf_dir)
    expected = tables.execute(SQL[name])
    names = [column[0] for column in expected.description]
    kinds = [_kind(column[1]) for column in expected.description]
    assert df.columns == names
    assert [_kind(kind) for _, kind in df.dtypes] == kinds
    got = _rows(df.select(*names).collect())
    assert got == _rows(expected.fetchall())
    assert got


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["term", "df", "corpus_count"]
    assert df.count() > 0
