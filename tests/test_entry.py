import __spark_entry__ as entry_point


def test_entry(spark):
    assert entry_point.entry(spark).count() == 1


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_the_rest_works_without_the_text_operators(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(entry_point.__file__).parent
    shutil.copytree(root / "lumenfield", tmp_path / "lumenfield", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'zonal_annual' in q and not any(n.startswith('op') or n == 'pipeline' for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, check=True)
