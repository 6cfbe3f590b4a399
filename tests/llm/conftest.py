import pytest

LONG = " ".join(f"word{i % 977} filler{i % 13}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, clashing names."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog", "en", "a", 43, "x", 1),
        (1, "The quick brown fox jumps over the lazy dog", "en", "a", 43, "x", 1),
        (2, "The quick  brown\tfox jumps\nover the lazy dog", None, None, None, None, None),
        (3, None, None, None, None, None, None),
        (4, "", "en", "b", 0, "y", 2),
        (5, " \t\n ", "fr", "b", 4, "y", 2),
        (6, LONG, "en", "a", len(LONG), "z", 3),
        (7, LONG, "en", "a", len(LONG), "z", 3),
        (8, "été où ça über größe señor niño", "fr", "c", 31, "z", 3),
        (None, "a row without an id", "en", "c", 19, None, None),
        (9, "12345 67890 !!! ---", "de", "c", 19, "q", 9),
        (10, "one", "de", "c", 3, "q", 9),
    ]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
              "digest string, shard int")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def small(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
