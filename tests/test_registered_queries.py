"""Every registered query against its DuckDB statement, and the driver's entry points."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
import __spark_entry__  # noqa: E402
import compare  # noqa: E402
from episodica.plans import registry  # noqa: E402

needs_data = pytest.mark.skipif(not compare.DATA.exists(), reason="test tables are missing")


@needs_data
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare.rows_of_query(registry.QUERIES[name](spark, str(compare.DATA))) == compare.rows_of_sql(registry.ORACLES[name])


@needs_data
def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_registration():
    queries, statements = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(registry.QUERIES) <= set(queries) and set(statements) <= set(queries)


def test_the_rest_works_without_the_corpus_subpackage(tmp_path):
    """A copy of the repository without its folders still imports and registers its other queries, and passes tests."""
    import shutil
    import subprocess

    root = Path(__spark_entry__.__file__).parent
    shutil.copytree(root / "episodica", tmp_path / "episodica", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(root / "tests", tmp_path / "tests", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})
    tests = ["tests/test_text_and_hash.py", "tests/test_registered_queries.py", "-k", "blake3 or preview or literals or ledger_upsert or normalize_meta"]
    subprocess.run([sys.executable, "-m", "pytest", "-q", "-x", "-p", "no:cacheprovider", *tests], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
