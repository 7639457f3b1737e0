import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, words string, label int, place long"


def prose(seed: int, n: int) -> str:
    """Words that hardly repeat."""
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice("aeioubcdfglmnprst") for _ in range(r.randint(3, 9))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns with names that operators use."""
    texts = [None, "", " \t\n", "one", prose(1, 60), prose(1, 60), prose(2, 30_000), "x " * 5000, "word!! " * 40, prose(3, 50) + "\n" + prose(3, 50)]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 == 0 else f"s{i % 3}", None, 7, None, "w", 3, 1) for i, t in enumerate(texts)]
    rows += [rows[4], (None, prose(1, 60), None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(4, 1, 0), (4, 1, 0), (8, 0, 1), (9, 1, None), (None, 1, 1), (99, 1, 0), (6, 1, 0), (7, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
