import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
for path in (ROOT, os.path.join(ROOT, "tests"), os.path.join(ROOT, "tests", "llm")):
    if path not in sys.path:
        sys.path.insert(0, path)

from fixtures_llm import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use themselves."""

    def documents(rows, columns=SCHEMA):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, columns).repartition(3)

    return documents


@pytest.fixture(scope="session")
def odd_rows():
    """Null and blank texts, null ids, repeated rows, one id with two texts, and long texts."""
    same = prose(120, 1)
    return [
        (1, same), (2, same), (2, same), (3, same + " " + prose(40, 2)), (4, None), (5, ""), (6, " \n\t "),
        (None, same), (None, prose(30, 3)), (7, prose(30, 4)), (7, prose(30, 5)), (8, "a" * 30_000),
        (9, "the " * 5_000), (10, "é" * 300 + " " + "あ" * 200), (11, prose(3, 6)), (12, "x"),
        (13, " ".join([same, prose(200, 7), same])), (14, prose(3000, 8)),
    ]
