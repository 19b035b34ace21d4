import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from spelltide.llm.queries import prepared


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    prepared(spark)


DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of documents from (id, text) or (id, text, source) rows."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "web", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return make
