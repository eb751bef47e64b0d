import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from docrank.session import local_session
    s = local_session("*", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture
def tmp_out(spark):
    from docrank.session import scratch_path
    return lambda name: scratch_path(spark, name)


def corpus_df(spark, rows):
    """(doc_id, text) corpus from literal rows."""
    from docrank.sources.corpus import from_table
    return from_table(spark.createDataFrame(rows, "doc_id string, text string"))
