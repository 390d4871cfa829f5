"""Every registered query against its DuckDB twin (small scale), and the
driver entry point."""

from __spark_entry__ import entry, oracle_sql, queries
from occurrence_lake.plans.driver_queries import QUERIES
from oracle_compare import compare

from conftest import SF_SMALL


def test_registry_is_complete():
    assert set(oracle_sql()) <= set(queries())
    assert len(queries()) >= 20


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["taxon_key", "all_occurrence_coordinates"]
    assert df.count() > 0


def test_all_queries_match_oracle(spark):
    res = compare(spark, SF_SMALL, list(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if v.get("ok") is not True}
    assert not bad, bad


def test_entry_works_without_the_training_data_operators(tmp_path):
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "copy"
    copy.mkdir()
    shutil.copy(f"{root}/__spark_entry__.py", copy)
    shutil.copytree(f"{root}/occurrence_lake", copy / "occurrence_lake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                          cwd=copy, capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert said.stdout.split() == [str(len(QUERIES))] * 2, said.stderr
