import pytest

from forecourt.llm.common import share_code

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def _code_on_workers(spark):
    share_code(spark)


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text[, source[, lang]]) tuples, with a column that clashes."""

    def make(rows):
        full = [
            (r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s", 0, "x")
            for r in rows
        ]
        return spark.createDataFrame(full, DOC + ", size string")

    return make


def with_clashes(docs):
    """Extra columns named like the helper columns that operators might add."""
    names = (
        "__id __same __key __words __items __spans __passes __text __lang ___id lost lost_words "
        "node size rank root key host line n"
    ).split()
    from pyspark.sql import functions as F

    return docs.withColumns({n: F.lit("own") for n in names})


AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b "),
    (4, "one"),
    (5, "a b c d e f g"),
    (5, "a b c d e f g"),
    (None, "no id at all"),
    (None, None),
    (6, "Größe ñandú 漢字 \U0001f600 a'b don't\r\nx"),
    (7, "long words again and again " * 4000),
    (8, "x", None),
]
