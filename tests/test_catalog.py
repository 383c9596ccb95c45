"""Every registered query against its DuckDB oracle on the smallest driver
tables, plus the driver contract (entry smoke, column-name agreement)."""

import importlib.util
from pathlib import Path

import duckdb
import pytest

from tests.conftest import SF_SMALL

ROOT = Path(__file__).resolve().parents[1]


def load(path, name):
    spec = importlib.util.spec_from_file_location(name, path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


from ledgerlake.plans import catalog as core  # noqa: E402

entry = load(ROOT / "__spark_entry__.py", "spark_entry")
check = load(ROOT / "scripts" / "check_oracle.py", "check_oracle")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["nation", "year", "valor", "valor_base", "valor_pct_gdp", "valor_usd"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_documented():
    missing = set(core.QUERIES) - set(entry.oracle_sql())
    assert missing == set()


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [r.asDict() for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
    assert sorted(df.columns) == sorted(dcols)
    cols = sorted(dcols)
    assert check.rows_of(srows, cols) == check.rows_of(drows, cols)


def test_partitioning_does_not_change_results(spark):
    """Metamorphic check: more input partitions, same running balances."""
    q = entry.queries()["q23_running_balance"]
    base = sorted(map(tuple, q(spark, SF_SMALL).collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        again = sorted(map(tuple, q(spark, SF_SMALL).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert base == again


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "ExistingRDD")


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_plan_has_no_cross_join_or_python(spark, name):
    """Plans stay JVM-side and never pair rows without an equi-key."""
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [k for k in FORBIDDEN if k in plan] == []


def test_metamorphic_fills_sum_to_facet_totals(spark):
    s = entry.queries()["q39_annual_series_job"](spark, SF_SMALL)
    from pyspark.sql import functions as F
    by_fill = {(r["empresa"], r["year"], r["facet_col"]): r["v"] for r in
               s.groupBy("empresa", "year", "facet_col").agg(F.sum("valor").alias("v")).collect()}
    from ledgerlake.plans import accounts, catalog
    acts = catalog.thousand_accounts(spark, SF_SMALL).where(accounts.annual_branches())
    cls = catalog.classify(acts, catalog.DRIVER_RULES)
    direct = {(r["empresa"], r["year"], r["facet_col"]): r["v"] for r in
              cls.groupBy("empresa", "year", "facet_col").agg((F.sum("valor") * 1e3).alias("v")).collect()}
    assert by_fill.keys() == direct.keys()
    for k, v in direct.items():
        assert by_fill[k] == pytest.approx(v)


def test_metamorphic_balance_steps_equal_movements(spark, duck):
    bal = {(r["nk"], r["fecha"]): r["saldo"] for r in entry.queries()["q23_running_balance"](spark, SF_SMALL).collect()}
    mov = {(nk, d): float(v) for nk, d, v in duck.execute("""
        SELECT c_nationkey, CAST(date_trunc('month', o_orderdate) AS DATE), sum(CAST(o_totalprice AS DECIMAL(18,2)))
        FROM orders JOIN customer ON c_custkey = o_custkey
        WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) GROUP BY ALL""").fetchall()}
    checked = 0
    for (nk, d), saldo in bal.items():
        if d.month > 2 and saldo is not None:
            prev = bal.get((nk, d.replace(month=d.month - 1)))
            if prev is not None:
                assert saldo - prev == pytest.approx(-mov[(nk, d)])
                checked += 1
    assert checked > 0
