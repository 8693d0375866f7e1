import pytest


@pytest.fixture()
def frame(spark):
    """Rows -> DataFrame with a schema string, spread over three partitions."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(3)
    return make


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = DOCS + ", size long, h long, n long, digest string, component string, kept boolean, block int, part long"


def documents(texts, lang="en", source="s"):
    return [(i, t, lang, source, len(t) if t is not None else None) for i, t in enumerate(texts)]


def with_clashes(rows):
    return [(*r, 1, 2, 3, "x", "y", True, 4, 5) for r in rows]
