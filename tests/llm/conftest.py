import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """A function: rows (doc_id, text, lang, source) as a documents table."""
    def make(rows):
        return spark.createDataFrame([(*r, len(r[1]) if r[1] else 0) for r in rows], DOCS)
    return make

