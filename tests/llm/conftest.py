import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from panelsight.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=4)
    yield s


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return sorted((r.doc_id, r.text) for r in docs.collect())


#: doc_id, text, and columns whose names the operators use inside
AWKWARD = "doc_id long, text string, lang string, row string, score double, batch int, h string, n int, uid string, kept int"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing column names."""
    long = " ".join(f"word{i % 997} and{i}" for i in range(60_000))
    same = "One two three four five six seven.\nEight nine ten eleven twelve thirteen fourteen.\nFifteen sixteen seventeen."
    data = [
        (1, same, "en"), (1, same, "en"), (2, same, "en"), (None, same, "en"), (None, None, None), (3, None, "en"), (4, "", None),
        (5, "  \n\n ", "de"), (6, "a", "de"), (7, long, "en"), (8, long + " more words", None), (9, "!!! 123 ???", "fr"), (2, "another text of the same id", "fr"),
    ]
    return spark.createDataFrame([(i, t, g, "r", 0.5, k, "h", 1, "u", 0) for k, (i, t, g) in enumerate(data)], AWKWARD)
