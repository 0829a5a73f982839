import pytest

SMALL = "/root/testdata/sf0.001"
#: Columns whose names the operators use inside.
EXTRA = (
    "node", "cell", "row", "score", "size", "bucket", "label", "key", "gone_id", "__gone", "__key", "__rows", "__more", "__score", "__size", "__copy",
    "__id", "__number", "__spans", "carried column 5",
)


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text, lang, source), with columns of clashing names."""

    def build(rows):
        schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{x}` string" for x in EXTRA)
        return spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in rows], schema)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows."""
    text = "the quick brown fox jumps over the lazy dog and runs away from it"
    return [
        (1, text, "en", "a"),
        (2, None, None, None),
        (3, "", "en", "a"),
        (4, " \t\n ", "en", None),
        (5, text.upper(), None, "b"),
        (6, text, "en", "b"),
        (6, text, "en", "b"),
        (None, text, "en", "a"),
        (None, None, None, None),
        (7, "word " * 60_000 + "end", "en", "c"),
        (8, "x" * 300_000, "en", "c"),
        (9, "one", "de", "a"),
        (10, "one", "de", "a"),
        (11, "été 😀 ǆ !! 42", "fr", "a"),
    ]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
