import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " \
    "hits string, row string, fp string, bad_lines string, host_of string, extra string"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents from (doc_id, text[, source]); other columns have names operators use too."""
    def make(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None,
                 "h", "r", "f", "b", "o", "e") for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd():
    """Null, empty, blank, odd, long and repeated texts."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "Two words"), (6, long), (6, long),
        (7, "same text here again"), (8, "same text here again"), (None, "same text here again"),
        (None, None), (9, "é" * 50_000), (10, "1" * 50_000), (11, "a." * 20_000 + "@"),
        (12, "  zero\u0000byte \U0001f600 smile"), (13, "x" * 100_000 + "\n" + "y"),
    ]
