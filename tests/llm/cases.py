"""Small tables with the awkward rows every operator must take."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("keep_id", T.StringType()), T.StructField("score", T.StringType()), T.StructField("fp", T.StringType()),
    T.StructField("kept", T.StringType()), T.StructField("row", T.StringType()), T.StructField("id", T.StringType())])

LONG = ("word%d " * 3000) % tuple(range(3000)) + "x" * 20_000
ROWS = [
    (1, "Alpha beta gamma delta epsilon"), (2, "alpha BETA gamma delta epsilon"), (2, "alpha BETA gamma delta epsilon"),
    (3, None), (4, ""), (5, "  \n\t "), (None, "alpha beta gamma delta epsilon"), (None, None), (6, LONG), (7, LONG.upper()),
    (8, "Ä ä Österreich"), (9, "ä Ä Österreich"), (10, "one two"), (10, "one two three"), (11, "é" * 5000),
]


def documents(spark, rows=ROWS):
    extra = ("a", "b", "c", "d", "e", "f")
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t else None, *extra) for i, t in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
