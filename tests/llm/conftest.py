from pathlib import Path

import pytest

SF_DIR = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, with ids from 1, and a clashing extra column."""

    def build(*texts, source="s"):
        rows = [(i + 1, t, "en", source, "x", 7) for i, t in enumerate(texts)]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, size string, cid int"
        )

    return build


@pytest.fixture(scope="session")
def sf_dir():
    if not SF_DIR.exists():
        pytest.skip("benchmark tables not present")
    return str(SF_DIR)
