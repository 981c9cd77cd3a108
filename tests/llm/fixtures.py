"""Small tables with the awkward rows every operator must take."""

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"w{i % 977} x{i}" for i in range(20_000))


def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns with likely names."""
    rows = [
        (1, "one two three four five six seven eight nine ten", "en", "a", 10),
        (2, "one two three four five six seven eight nine ten", "en", "a", 10),
        (2, "one two three four five six seven eight nine ten", "en", "a", 10),
        (3, None, None, None, None),
        (4, "", "en", None, 0),
        (5, " \n\t ", "de", "b", 4),
        (None, "a text without an id", None, "b", None),
        (None, None, None, None, None),
        (6, LONG, "en", "c", len(LONG)),
        (7, "12 34 -- !!", "fr", "c", 11),
        (8, "日本語 テスト é ß \u0007 x", "xx", "", 3),
        (-9, "one two three four five six seven eight nine eleven", "en", "a", 10),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(df):
    """The same rows with columns called like those that operators make for themselves."""
    names = "id key hash fp root cell lane run place row found body words kept _d _g slot start size shard chunk _rows _copies _key _copy _part _row doc copies part rows copy".split()
    return df.select("*", *[F.lit("clash").alias(n) for n in names])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def check_awkward(spark, operator):
    """`operator` gives the same rows with clashing columns, and none for an empty table."""
    plain = sorted_rows(operator(awkward(spark)))
    assert sorted_rows(operator(with_clashes(awkward(spark)))) == plain
    assert operator(empty(spark)).count() == 0
    return plain
