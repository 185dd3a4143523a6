import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, _src int, toxic string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty and long texts, ties, repeated rows and clashing extra columns."""
    line = "the quick brown fox jumps over the lazy dog again and again"
    rows = [
        (1, "Alpha beta gamma delta epsilon\nzeta eta theta iota kappa\nlast line of all", "en", "a", 10, "x", 1, None),
        (2, "Alpha beta gamma delta epsilon\nzeta eta theta iota kappa\nanother end here", "en", "b", 10, None, 2, "w"),
        (2, "Alpha beta gamma delta epsilon\nzeta eta theta iota kappa\nanother end here", "en", "b", 10, None, 2, "w"),
        (3, None, "en", "a", None, "x", None, None),
        (4, "", None, None, 0, None, None, None),
        (5, "   \n\t ", "de", "c", 6, None, None, None),
        (None, "no id here but words", "fr", "é", 20, None, None, None),
        (6, None, None, None, None, None, None, None),
        (7, "Ünïcödé “quotes” naïve \U0001f600 \x1c tab\tend\u00a0nbsp", "fr", "é", 5, None, None, None),
        (8, (line + "\n") * 400, "en", "a", 5, None, None, None),
        (9, (line + "\n") * 400, "en", "a", 5, None, None, None),
        (10, "one", "en", "", 3, None, None, None),
        (11, "x" * 5000, "en", "a", 3, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
