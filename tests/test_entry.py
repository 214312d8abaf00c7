"""The driver contract, with and without the optional parts."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), *sorted(e.queries()))"


def listed(folder):
    run = subprocess.run([sys.executable, "-c", SHOW], cwd=folder, capture_output=True, text=True, check=True)
    n_queries, n_sql, *names = run.stdout.split()
    return int(n_queries), int(n_sql), names


def test_entry_works_without_the_optional_parts(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(
        ROOT, copy, ignore=lambda folder, names: [n for n in names if n in (".git", "llm", "corpus_pipeline.py", "__pycache__")]
    )
    n_queries, n_sql, names = listed(copy)
    assert "feature_table" in names and not any(n.startswith("op") and n[2].isdigit() for n in names)
    whole = listed(ROOT)
    assert set(names) <= set(whole[2]) and n_sql <= whole[1] and n_queries <= whole[0]


def test_queries_find_their_tables(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[0] == "entity"
    assert entry.queries()["select_prefix"](spark, "/root/testdata/sf0.001").columns == [
        "l_linenumber", "l_returnflag", "l_linestatus"
    ]
