"""Driver contract: entry() runs; every oracle key is a query; every SQL
oracle equals its Spark query on sf0.001 (the driver checks sf0.01)."""

import pathlib
import re
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest, frame_rows
from tests.conftest import SF_SMALL

def test_entry_has_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "accuracy" in df.columns


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL).toPandas()
    ddf = duck.execute(E.oracle_sql()[name]).df()
    sc, sr = frame_rows(sdf)
    dc, dr = frame_rows(ddf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert digest(sr) == digest(dr), (sorted(set(sr) - set(dr))[:3], sorted(set(dr) - set(sr))[:3])


def test_every_query_of_the_library_has_sql():
    """Those of the optional training-data folder have tests of their own."""
    own = {k for k in E.queries() if not re.match(r"op\d+_|pipeline$", k)}
    assert len(own) > 60 and own <= set(E.oracle_sql())


def test_the_library_stands_without_the_optional_folder(tmp_path):
    """A copy without the training-data folder and the pipeline still
    imports, and registers everything else."""
    root = pathlib.Path(E.__file__).parent
    shutil.copytree(root, tmp_path / "copy", ignore=lambda d, names: [
        n for n in names if n in ("llm", "corpus_pipeline.py", ".git", "__pycache__")])
    code = "import __spark_entry__ as E; q = E.queries(); print(len(q), sum(k[:2] == 'op' and k[2].isdigit() for k in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, check=True)
    n, ops = map(int, out.stdout.split()[-2:])
    assert n > 60 and ops == 0
