import os
import sys

import pytest
from llm_tables import DOCS, clashing

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from tonearm.llm.common import ship
    from tonearm.session import local_session

    s = local_session(8, app="tonearm-llm-tests", shuffle_partitions=8, driver_memory="8g")
    ship(s)
    return s


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
    rows = [(1, "The quick brown fox jumps over the lazy dog by the river", "en", "a", 10),
            (1, "The quick brown fox jumps over the lazy dog by the river", "en", "a", 10),
            (2, None, "en", "a", None), (3, "", None, None, 0), (4, " \n\t ", "de", "b", 4),
            (5, long, "en", "b", len(long)), (None, "Der schnelle braune Fuchs springt", "de", None, 3),
            (6, "x" * 50_000, "en", None, 50_000), (7, "日本語のテキスト🙂 ▁ok", "ja", "é", 9),
            (8, "THE QUICK brown fox jumps over the lazy dog by the river", "en", "a", 10),
            (9, "1234 5678 %%%", "de", "a", 13), (None, None, None, None, None)]
    return clashing(spark.createDataFrame(rows, DOCS))


@pytest.fixture(scope="session")
def no_docs(spark):
    return clashing(spark.createDataFrame([], DOCS))
