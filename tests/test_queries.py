"""Every registered query with an SQL twin against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from hazardloom import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def _plain(v):
    if v is None or v != v:
        return "NULL"
    return f"{v:.6f}" if isinstance(v, float) else str(v)


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_same_rows_as_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    want = duck.execute(registry.ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, got.collect()) == rows(names, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_repository_needs_no_llm_folder(tmp_path):
    import shutil
    import subprocess
    import sys

    here = os.path.dirname(entry.__file__)
    shutil.copytree(f"{here}/hazardloom", tmp_path / "hazardloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{here}/__spark_entry__.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()))"], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(registry.QUERIES)), "False"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(registry.QUERIES["range_read"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "o_orderpriority" not in plan
    assert "EqualTo(user_id,7)" in _plan(registry.QUERIES["by_key_read"](spark, SF))


def test_radius_join_is_an_equi_join(spark):
    plan = _plan(registry.QUERIES["radius_rates"](spark, SF))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", ["area_entries", "area_sentences", "signal_areas", "top_split", "bulletin_fields"])
def test_texts_made_of_one_small_file_are_read_in_many_tasks(spark, name):
    assert registry.QUERIES[name](spark, SF).rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
