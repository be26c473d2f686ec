import os
import sys
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from textmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def out(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


@pytest.fixture
def texts(spark):
    """A table of (doc_id, text) from a list of texts."""

    def make(items, parts=3):
        return spark.createDataFrame(list(enumerate(items)), "doc_id bigint, text string").repartition(parts)

    return make


@pytest.fixture
def column(texts):
    """Values of a text column function, in input order."""

    def run(fn, items):
        from pyspark.sql import functions as F

        rows = texts(items).select("doc_id", fn(F.col("text")).alias("x")).collect()
        return [r.x for r in sorted(rows)]

    return run
