import pytest

from gridclimate.llm.shipping import send_package


@pytest.fixture(scope="session", autouse=True)
def package_on_executors(spark):
    send_package(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs, empty and blank texts, ties, repeated rows, a very long text, clashing names."""
    long_text = " ".join(f"word{i % 977} other{i % 31}." for i in range(30_000))
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    near = " ".join([base] * 6 + ["end of the tale"])
    rows = [
        (1, "Hello  World"), (2, "HelloWorld "), (3, "Hello World"), (3, "Hello World"),
        (4, None), (5, ""), (6, " \t\n"), (None, "Hello World"), (None, None),
        (7, long_text), (8, long_text), (9, near), (10, near.replace("tale", "story")),
        (11, "ünïcödé 日本語 😀 ▁ <s> <|endoftext|>"), (12, "one two"), (13, "ONE\x0btwo"),
    ]
    return spark.createDataFrame(
        [(i, t, "row", 5, "score", "src") for i, t in rows],
        "doc_id long, text string, row string, ids int, score string, source string",
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
