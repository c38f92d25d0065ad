import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from samples import prose  # noqa: E402


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty, blank, tiny and long texts, exact and near copies, repeated rows, clashing names."""
    long = prose(1, 6000)
    near = prose(2, 200).split()
    near[100] = "changed"
    rows = [
        (0, None, None, None),
        (1, "", "en", "a"),
        (2, " \n\t ", "en", "a"),
        (3, "word", None, "b"),
        (4, long, "en", "b"),
        (5, prose(2, 200), "en", "b"),
        (6, prose(2, 200), "en", "b"),
        (7, " ".join(near), "en", "b"),
        (8, prose(3, 80) + "\n" + prose(5, 40), "en", "c"),
        (9, prose(4, 60) + " " + prose(5, 40), "en", "c"),
        (10, "echo " * 300, "en", "c"),
        (11, "ÉTÉ été 日本 " + prose(6, 30), "fr", "c"),
        (11, "ÉTÉ été 日本 " + prose(6, 30), "fr", "c"),
        (None, prose(7, 70), "en", None),
        (None, prose(7, 70), "en", None),
        (12, prose(8, 9), "en", "d"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names = ["words", "k", "id", "n_words", "label", "score", "row", "_id", "_text_hash", "c_id", "mini", "length"]
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("clash") for n in names}).cache()


@pytest.fixture
def texts_of():
    return lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
