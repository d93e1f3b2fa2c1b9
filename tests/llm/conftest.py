import pytest


@pytest.fixture
def docs(spark):
    """A function from texts (or (doc_id, text)) to a documents table, with extra columns of clashing names."""

    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        ddl = "doc_id long, text string, lang string, source string, n_chars long, fp string, word string, label int, rank int, component_id long, score double, part string, length string, kept boolean, quality string"
        out = [(i, t, "en", "src0", len(t or ""), "x", "y", 3, 4, 5, 0.5, "p", "l", True, "q") for i, t in rows]
        return spark.createDataFrame(out, ddl).repartition(3)

    return make


ODD = [None, "", "   \n\t", "one", "one two three", "same words here again and again", "same words here again and again", "ü ß é — 你好 🎉 \x00 zero", "a" * 5000, "x y z " * 30_000]


@pytest.fixture
def odd(docs):
    """Null, empty, blank, short, repeated, non-ASCII and very long texts; a repeated row and rows without doc_id."""
    return docs([*enumerate(ODD), (3, "one"), (None, "no id"), (None, None)])
