import pytest

LONG = "lorem ipsum dolor sit amet consetetur " * 20_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, copies, repeated rows and columns whose names operators use themselves."""
    base = "the quick brown fox jumps over the lazy dog while twelve other animals watch from the old fence"
    rows = [
        (1, base),
        (2, base.upper()),
        (3, base.replace("lazy", "sleepy")),
        (3, base.replace("lazy", "sleepy")),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, LONG),
        (8, LONG),
        (None, base),
        (None, None),
        (9, "été ÉTÉ übung 12 % ++"),
        (10, "x"),
    ]
    names = ["node", "bundle", "row_hash", "kept", "score", "part", "lines", "piece", "count", "token", "_gone"]
    return spark.createDataFrame(
        [(*r, *["c"] * len(names)) for r in rows],
        "doc_id long, text string, " + ", ".join(f"{n} string" for n in names),
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
