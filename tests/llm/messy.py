"""Documents with nulls, empty and long texts, ties and repeated rows, and columns with clashing names."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(20_000))
PLAIN = "the quick brown fox jumps over the lazy dog and runs far away from the river bank today"

ROWS = [
    (3, PLAIN + " again and again.", "en", "a", 1),
    (1, PLAIN + " again and again.", "en", "a", 1),
    (2, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \n\t ", "xx", None, 4),
    (6, LONG, "en", "b", len(LONG)),
    (7, "ÜBER straße — 中文 🙂 naïve\n\n  two  spaces <|endoftext|> 'll re", "de", "b", None),
    (8, "repeated row " * 30, "en", "a", 1),
    (8, "repeated row " * 30, "en", "a", 1),
    (9, "same id, one text " + PLAIN, "en", "c", 1),
    (9, "same id, another text " + PLAIN[::-1], "en", "c", 1),
    (None, "no id at all " + PLAIN, "en", "c", 1),
    (None, "no id at all " + PLAIN, "en", "c", 1),
    (10, "x", "en", "d", 1),
]


def messy(spark: SparkSession) -> DataFrame:
    """The rows above, with extra columns named like those that operators make."""
    df = spark.createDataFrame(ROWS, SCHEMA)
    names = "rep bucket component kept score labels a b tag span start shard _id _key _tokens block n"
    return df.withColumns({c: F.lit(1) for c in names.split()})


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def rows(df: DataFrame) -> list[tuple]:
    """All rows in a stable order; nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
