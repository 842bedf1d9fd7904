"""Every query of the library against its SQL, and the entry module without the corpus operators."""

import os
import subprocess
import sys

import duckdb
import pytest

from lorgnette import registry
from verify import TABLES, rows

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("the given tables aren't here")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, con, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), con.execute(registry.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("lorgnette.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as e
assert len(e.queries()) == len(e.oracle_sql()) > 40 and not any(q.startswith("op") and q[2].isdigit() or q == "pipeline" for q in e.queries())
"""


def test_entry_without_corpus_operators():
    subprocess.run([sys.executable, "-B", "-c", HIDE], cwd=ROOT, check=True, env=os.environ | {"PYTHONPATH": ROOT})


def test_nothing_else_imports_the_corpus_operators():
    for folder, _, names in os.walk(os.path.join(ROOT, "lorgnette")):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    with open(os.path.join(folder, n)) as f:
                        assert "llm" not in f.read(), n
