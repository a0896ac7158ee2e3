import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{k}" for k in range(20_000))
ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "...",
    "one",
    "one two three",
    "Ünïcode 漢字 €uro 🙂 naïve",
    "a  b\n\n c\t\td \x00 e",
    LONG,
    "x" * 5_000,
    "ab" * 2_000,
]


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, a null id, and extra columns
    named like those the operators make."""
    rows = [(k, t, None if k % 3 else "en", None if k % 2 else "s", None) for k, t in enumerate(ODD_TEXTS)]
    rows += [(4, "one", None, "s", 3), (4, "one", None, "s", 3), (None, "one two three", "en", None, None)]
    extra = ("score", "n_words", "component_id", "node", "host", "kept", "n", "label")
    df = spark.createDataFrame(rows, SCHEMA)
    for name in extra:
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(autouse=True)
def shipped(spark):
    from layerloom.llm.common import ship

    ship(spark)


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
