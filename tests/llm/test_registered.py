import importlib.util
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_one_query_for_each_operator():
    spec = importlib.util.spec_from_file_location("entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    names = [k for k in m.queries() if k.startswith("op") and k[2].isdigit()]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert "pipeline" in m.queries() and set(m.oracle_sql()) <= set(m.queries())


def test_workers_need_no_package(tmp_path):
    """Functions travel by value: a worker that cannot import the package runs them."""
    code = (f"import sys; sys.path.insert(0, {ROOT!r}); from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "from ledgerlens.llm import queries as q\n"
            "print('rows', q.op9_token_counts(s, '/root/testdata/sf0.001').count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 200" in done.stdout, done.stderr[-2000:]
