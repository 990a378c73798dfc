import pytest


def clashing(df):
    """Columns named like those the operators make for themselves."""
    from pyspark.sql import functions as F

    names = ("id", "key", "node", "n", "part", "words", "start", "host", "lines", "score", "n_words", "component_id")
    return df.select("*", *[F.lit("x").alias(c) for c in names if c not in df.columns])


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty texts, repeats, ties, long texts, and columns with clashing names."""
    long_text = " ".join(f"word{i % 977} of{i % 31}" for i in range(20_000))
    base = " ".join(f"alpha{i}" for i in range(60))
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (2, base, "en", "a"),
        (3, base + " omega", "fr", "a"),
        (4, None, None, None),
        (5, "", "en", "a"),
        (6, "  \n\t ", "en", "b"),
        (7, long_text, "en", "b"),
        (8, "one two", "en", "b"),
        (9, "ONE  two", "en", "b"),
        (None, base, "de", "b"),
        (None, "one", None, "b"),
        (10, "x" * 50_000, "en", "c"),
        (11, "é漢字🤖 ½ Ⅷ <|endoftext|> it's  fine\r\n", "fr", "c"),
    ]
    return clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))


@pytest.fixture(scope="session")
def benchmark(spark):
    rows = [
        (1, " ".join(f"alpha{i}" for i in range(20, 40))),
        (1, " ".join(f"alpha{i}" for i in range(20, 40))),
        (2, "one two"),
        (3, None),
        (4, "!!"),
        (None, "fine"),
        (5, "Alpha3 ALPHA4, alpha5"),
    ]
    return clashing(spark.createDataFrame(rows, "item_id long, text string"))
