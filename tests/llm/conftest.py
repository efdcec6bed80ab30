import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no benchmark tables")
    return SF_DIR


@pytest.fixture
def documents(spark):
    """Make a table of documents from texts, with columns whose names clash with inner ones."""
    def make(texts, ids=None, langs=None):
        rows = [(i if ids is None else ids[i], t, None if langs is None else langs[i], "s", None, "x", 1, "y", 2, b"k")
                for i, t in enumerate(texts)]
        return spark.createDataFrame(
            rows, "doc_id bigint, text string, lang string, source string, n_chars bigint,"
                  " row string, n int, label string, fp int, key binary")
    return make
