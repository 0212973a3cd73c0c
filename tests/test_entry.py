"""Driver contract: entry() runs, and every registered query equals its DuckDB oracle at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["split", "batch_id", "block_no", "n_tokens", "ids", "labels_same"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_known():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents conversations labels benchmark events embeddings pages").split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF)
    rel = con.sql(entry_mod.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


def test_library_starts_without_the_subpackage(tmp_path):
    """A copy without both llm folders imports, and keeps all other queries."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry_mod.__file__))
    copy = tmp_path / "repo"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.parquet"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries())); print(sorted(e.oracle_sql()))"],
                          cwd=copy, capture_output=True, text=True, timeout=300)
    assert said.returncode == 0, said.stderr
    core = sorted(k for k in entry_mod.queries() if k != "pipeline" and not k.startswith("op"))
    assert eval(said.stdout.splitlines()[0]) == core
    assert eval(said.stdout.splitlines()[1]) == [k for k in core if k in entry_mod.oracle_sql()]
