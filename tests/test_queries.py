"""Registered queries of the library against their SQL on the smallest tables."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from tesserae.plans import oracles
from tesserae.plans.queries import ALL

SF = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ROOT = Path(__file__).resolve().parents[1]
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("SET memory_limit='4GB'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(found, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(f"{r[i]:.6g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(oracles.ALL))
def test_query_equals_sql(spark, duck, name):
    df = ALL[name](spark, str(SF))
    got = rows([tuple(r) for r in df.collect()], df.columns)
    said = duck.execute(oracles.ALL[name])
    columns = [d[0] for d in said.description]
    assert sorted(columns) == sorted(df.columns) and got == rows(said.fetchall(), columns)


def test_cyclic_placement_places_or_names_every_tile(spark):
    flags = ALL["placement_flags_cyclic"](spark, str(SF)).toPandas()
    alive = ALL["alive_mask"](spark, str(SF)).groupBy("t").count().toPandas()
    both = flags.merge(alive, on="t")
    assert len(both) == len(alive) and (both.n_steps + both.n_unplaced == both["count"]).all()


def test_entry_works_without_the_corpus_operators():
    code = "import sys; sys.modules['tesserae.llm'] = None; import __spark_entry__ as e; assert len(e.queries()) > 50 and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=os.environ | {"PYTHONPATH": str(ROOT)}, check=True)
