"""Every catalogue query against its DuckDB oracle on the smallest driver tables."""

import hashlib
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from dryspell.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "supplier", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(E.queries())
    assert set(catalog.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_works_without_the_optional_subpackage():
    code = ("import sys; sys.modules['corpus_pipeline'] = None; sys.modules['dryspell.llm'] = None; "
            "import __spark_entry__ as E; from dryspell.plans import catalog; "
            "assert set(E.queries()) == set(E.oracle_sql()) == set(catalog.QUERIES)")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.abspath(E.__file__)))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["zone", "year", "spi"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(df.columns, srows) == _digest(ocols, orows)


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plans_have_no_cross_joins_or_python(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan], plan


@pytest.mark.parametrize("name", ["spi_by_region", "zone_histogram", "nearest_region", "matrix_melt"])
def test_queries_hold_without_adaptive_execution(spark, con, name):
    """Results do not depend on AQE or the shuffle partition count."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        df = E.queries()[name](spark, SF)
        srows = [tuple(r) for r in df.collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert _digest(df.columns, srows) == _digest(ocols, res.fetchall())
