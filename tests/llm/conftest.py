import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def odd(spark):
    """Rows with nulls, empty and blank texts, repeats, a long text and names that clash."""
    long = " ".join(f"w{i % 977}" for i in range(40_000))
    rows = [
        (1, "one two three four five six seven eight nine ten", "x", 1.0),
        (1, "one two three four five six seven eight nine ten", "x", 1.0),
        (2, None, None, None), (3, "", "y", 2.0), (4, " \t\n ", "z", None), (None, "no id here at all", "x", 0.0),
        (5, long, "x", 1.0), (6, long, None, 1.0), (7, "Short", "x", 1.0), (8, "naïve café 中文 🙂 <|endoftext|> x", "x", 1.0),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, score double")


@pytest.fixture
def none(odd):
    return odd.limit(0)
