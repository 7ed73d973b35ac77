"""Every registered query with SQL gives DuckDB's rows; the entry works without the text subpackage."""

import subprocess
import sys

import duckdb
import numpy as np
import pandas as pd
import pytest

from entityspark import queries as Q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
        return None
    if isinstance(v, (list, tuple, np.ndarray)):
        return [plain(x) for x in v]
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, float, np.integer, np.floating)):
        return round(float(v), 5)
    return str(v)[:10] if hasattr(v, "isoformat") else str(v)


def rows(df):
    return sorted((str([plain(v) for v in r]) for r in df[sorted(df.columns)].itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", Q.QUERIES)
def test_query(spark, duck, name):
    got = Q.QUERIES[name](spark, SF).toPandas()
    if name in Q.ORACLES:
        assert rows(got) == rows(duck.execute(Q.ORACLES[name]).df())
    else:
        assert len(got) > 0


def test_entry_without_the_text_subpackage(tmp_path):
    import os
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/entityspark", tmp_path / "entityspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)
