"""Every registered query against its SQL, and the rules on how queries are written."""

import ast
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry
from siltstone_checks.registry import ORACLE, QUERIES, with_position

ROOT = Path(__file__).resolve().parent.parent
#: Large enough for NULLs and misses in every derived input.
MIDDLE = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events".split()
SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{MIDDLE}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, MIDDLE)
    answer = duck.sql(ORACLE[name])
    order = sorted(answer.columns)
    assert sorted(df.columns) == order
    types = dict(zip(answer.columns, map(str, answer.types), strict=True))
    assert dict(df.dtypes) == {c: SPARK_TYPES[t] for c, t in types.items()}
    got = sorted(map(repr, (tuple(r) for r in df.select(*order).collect())))
    quoted = ", ".join(f'"{c}"' for c in order)
    expected = sorted(map(repr, answer.project(quoted).fetchall()))
    assert got == expected
    assert got


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= spark_entry.queries().keys()
    assert ORACLE.keys() <= spark_entry.oracle_sql().keys()


def test_entry_has_rows(spark):
    assert spark_entry.entry(spark).count() > 0


def test_library_keeps_work_on_spark():
    """No whole frame on the driver, no row-wise Python, no cross joins."""
    banned = {"toPandas", "crossJoin", "udf", "pandas_udf", "localCheckpoint", "rdd", "toLocalIterator"}
    for path in (ROOT / "siltstone").rglob("*.py"):
        if "llm" in path.parts:  # free in style
            continue
        names = {n.attr for n in ast.walk(ast.parse(path.read_text())) if isinstance(n, ast.Attribute)}
        assert not names & banned, path


def test_positions_do_not_gather_in_one_task(spark):
    df = spark.range(0, 1000, 1, 8).orderBy("id", ascending=False)
    placed = with_position(df)
    assert "Coalesce" not in placed._jdf.queryExecution().toString()
    assert sorted(map(tuple, placed.select("position", "id").collect())) == [(i, 999 - i) for i in range(1000)]
