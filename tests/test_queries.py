"""Every query with SQL against DuckDB on the smallest tables; the others must give rows."""

import duckdb
import pytest

from probeloom import plans
from probeloom.plans.registry import TABLES
from tools.compare import canonical

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(plans.ORACLE))
def test_query_matches_sql(spark, con, name):
    df = plans.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = canonical([tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()])
    res = con.execute(plans.ORACLE[name])
    have = [d[0] for d in res.description]
    assert sorted(have) == cols
    assert got == canonical([tuple(r[have.index(c)] for c in cols) for r in res.fetchall()])


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE)))
def test_query_without_sql_gives_rows(spark, name):
    assert plans.QUERIES[name](spark, SF).limit(5).count() > 0


def test_entry_imports_without_the_corpus_package():
    """The rest of the library doesn't import it."""
    import ast
    from pathlib import Path

    import probeloom

    for path in Path(probeloom.__file__).parent.rglob("*.py"):
        if "llm" not in path.parts:
            for node in ast.walk(ast.parse(path.read_text())):
                names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                assert not any("llm" in n.split(".") for n in names), path
