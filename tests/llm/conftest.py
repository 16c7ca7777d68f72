import pytest

from touchpath.llm import common

TEXTS = [
    None, "", " \n ", "word", "the same few words the same few words",
    "The cat sat on the mat with the old dog and the quiet bird of the tall tree near a small house by the river",
    "The cat sat on the mat with the old dog and the quiet bird of the tall tree near a small house by the river",
    "mail a.b12@mail1.example.com or +1 (564) 555-4526\nand again\nand again\n",
    "é中\U0001f600 ###$$$ ||| !!!", "ab" * 20_000, "long text of many words " * 4_000,
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns with names the operators use."""
    common.ship(spark)
    rows = [(i, text, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, 0, "x", 1, 2.0) for i, text in enumerate(TEXTS)]
    rows += [rows[5], rows[5], (None, "no id here", "en", "s1", None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, n long, size double"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def documents(spark, folder):
    common.ship(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")
