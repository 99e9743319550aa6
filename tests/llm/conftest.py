import pytest

SF_DIR = "/root/testdata/sf0.001"
#: Columns that operators use as names of their own results.
CLASHES = ("n_words", "score", "kept", "spans", "component_id", "offset", "__text", "__spans", "repeats", "signature")
EMPTY = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows, clashing names."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    texts = [
        (1, None), (2, ""), (3, "  \n\t"), (4, "one"), (5, "one"), (6, long), (7, long), (7, long), (None, "some words without an id"),
        (None, None), (8, "Ünïcode ﬁne 漢字 😀   \x85 end"), (9, "a\x00b \x1c c"), (10, "x " * 3000), (11, "1" * 20_000), (12, "a." * 5_000 + "@"),
    ]
    rows = [(i, t, None if (i or 0) % 2 else "en", None, None, *([None] * len(CLASHES))) for i, t in texts]
    return spark.createDataFrame(rows, EMPTY + "".join(f", {c} int" for c in CLASHES))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EMPTY)
