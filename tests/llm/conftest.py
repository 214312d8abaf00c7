import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH")) if p)

import pytest  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text[, lang, source]) tuples."""

    def make(rows, extra=None):
        full = [(r + (None,) * 5)[:4] + (len(r[1]) if r[1] is not None else None,) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        return df.withColumns(extra) if extra else df

    return make


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
