import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    def make(rows, schema=DOCS):
        rows = [tuple(r) + (None,) * (len(schema.split(",")) - len(r)) for r in rows]
        return spark.createDataFrame(rows, schema)
    return make


@pytest.fixture(scope="session")
def odd_docs():
    """Nulls in every column, empty and blank texts, repeated rows, ties, a long text and names that clash."""
    long = "word " * 40_000 + "x" * 60_000
    rows = [(1, "the cat sat on the mat and went away again", "en", "a", 40), (1, "the cat sat on the mat and went away again", "en", "a", 40),
            (2, None, "en", "a", None), (3, "", None, "b", 0), (4, "   \n\t ", "fr", None, 6), (None, "le chat est sur la table", "fr", "b", 24),
            (None, None, None, None, None), (7, long, "en", "a", len(long)), (8, "12345 !!! ???", "en", "a", 13), (9, "\x00nul é\x00", "en", "c", 8)]
    return rows


#: Columns that the operators use inside.
CLASHES = ("score", "kept", "row", "key", "steps", "times", "own", "salt", "rate", "bucket", "pack_id", "shard", "others", "_gone", "_id",
           "n_removed", "component_id", "x", "label", "_source", "pack", "held_out")


@pytest.fixture()
def odd(docs, odd_docs):
    from pyspark.sql import functions as F
    return docs(odd_docs).withColumns({c: F.lit(c) for c in CLASHES})
