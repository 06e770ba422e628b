import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, spans string"
LONG = "the cat and the dog of the house " * 20000

#: Nulls in any column, empty and blank texts, a very long text, ties, repeated rows and clashing extra columns.
ODD = [
    (1, None, None, None, None, 1, "a"), (2, "", "en", "s", 0, 2, "b"), (3, " \n\t ", "en", None, 1, None, None),
    (4, LONG, "en", "s", len(LONG), 4, None), (5, "the same text for two ids", "en", "s", 1, 5, None),
    (6, "the same text for two ids", None, "s", 1, 5, None), (7, "a repeated row", "en", "s", 1, 5, None),
    (7, "a repeated row", "en", "s", 1, 5, None), (None, "a row without id", "en", "s", 1, 5, None),
    (8, "Straße élève año 中文 ß", "de", "s", 1, 5, None),
]


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], SCHEMA)
