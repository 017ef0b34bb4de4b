import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_imports_without_the_text_operators(tmp_path):
    keep = shutil.ignore_patterns("llm", ".git", "__pycache__", "corpus_pipeline.py", "*.parquet", "spark-warehouse")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=keep)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 80 and set(o) <= set(q) and 'pipeline' not in q; print(len(q))"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=os.environ | {"PYTHONPATH": str(tmp_path / "repo")}, check=True)


def test_flagship(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "ldlj_arm" in df.columns
