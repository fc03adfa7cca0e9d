import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, token string, digest long, n int, id string, words int"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and very long texts, ties, repeats and clashing column names."""
    base = " ".join(f"word{i}" for i in range(80)) + "."
    near = base.replace("word40", "other")
    long = " ".join(f"w{i % 5000}x{i % 7}" for i in range(30_000))
    texts = [
        (1, base), (2, base), (3, near), (4, None), (5, ""), (6, " \t\n "), (7, "one two"), (8, "One  TWO"), (9, long),
        (10, long + " end"), (11, base), (11, base), (12, None), (None, base), (None, None), (13, "a b c d e"), (13, "x y z u v"),
    ]
    rows = [(i, t, None, "s", None, "clash", 7, 1, "id", 2) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
