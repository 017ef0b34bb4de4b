import pytest

LONG = "word " * 30_000


@pytest.fixture(scope="session")
def rows(spark):
    """Awkward documents: nulls anywhere, empty and very long texts, repeated rows and ids, a column whose name clashes."""
    data = [
        (1, "Call me at a.b@c.example.com or +1 (565) 555-5579.", "en", "s0", 10, "x"),
        (1, "Call me at a.b@c.example.com or +1 (565) 555-5579.", "en", "s0", 10, "x"),
        (1, "another text under the same number", "en", None, None, None),
        (2, None, None, None, None, None),
        (3, "", "de", "s1", 0, "y"),
        (None, "a row without a number, but with some words in it", "en", "s1", 3, "z"),
        (None, None, None, None, None, None),
        (4, LONG, "en", "s0", len(LONG), None),
        (5, "password: hunter2hunter2 and 4041894974608795 \U0001f600", "fr", "s2", 1, "w"),
    ]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, score string")


@pytest.fixture(scope="session")
def none(rows):
    return rows.where("false")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
