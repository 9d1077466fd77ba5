"""Column functions on the hand-made edge rows."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from hearthlake.functions import (chunk_sentences, clean_review_text, haversine_km, lexicon_score, mask_address,
                                  mask_email, mask_phone, mask_pii, normalize_continent, normalize_country,
                                  week_end, week_start)
from hearthlake.operators.gold import ingredient_criticality


def one_col(spark, items, expr, type_="string"):
    df = spark.createDataFrame([(x,) for x in items], f"v {type_}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_mask_email(spark):
    got = one_col(spark, ["Ann@X.com", "a@b@c", "@x.com", "noat", None], mask_email)
    assert got == ["a***@x.com", "a***@c", "@x.com", "noat", None]


def test_mask_phone(spark):
    got = one_col(spark, ["5551234567", "555-123-4567", "123", "12"], mask_phone)
    assert got == ["555****67", "555-123-4****67", "****23", "12"]


def test_mask_address(spark):
    assert one_col(spark, ["12 High Street", "A St", None], mask_address) == ["12 Hig***", "A St***", None]


def test_mask_pii(spark):
    items = ["abcdef", "a", None]
    assert one_col(spark, items, lambda c: mask_pii(c, False)) == ["ab***", "a***", None]
    assert one_col(spark, items, lambda c: mask_pii(c, True)) == items


def test_country_and_continent(spark):
    assert one_col(spark, [" usa ", "us", "new zealand", None], normalize_country) == [
        "United States", "United States", "New Zealand", None]
    assert one_col(spark, ["northamerica", "middle EAST", None, " africa"], normalize_continent) == [
        "North America", "Middle East", None, "Africa"]


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 0.0, 180.0)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] == 0.0
    assert got[1] == pytest.approx(111.1949, abs=1e-4)
    assert got[2] == pytest.approx(20015.0868, abs=1e-4)
    assert not any(math.isnan(x) for x in got)


def test_chunking_intent(spark):
    got = one_col(spark, ["Great bread! But slow... Really?", "!!!", None],
                  lambda c: chunk_sentences(clean_review_text(c)), "string")
    assert got == [["great bread", "but slow", "really"], [], None]


def test_chunking_literal_definition_gives_single_characters(spark):
    # The original split pattern also matches the empty string, so every
    # character (including the '|' inserted for punctuation) is a chunk.
    got = one_col(spark, ["Hi. Yo"], lambda c: chunk_sentences(clean_review_text(c), literal=True))
    assert got == [["h", "i", "|", "|", "y", "o"]]


def test_cleaning_keeps_letters_digits_whitespace_punctuation(spark):
    assert one_col(spark, ["Café #1 — ok?!"], clean_review_text) == ["caf   1   ok?!"]


def test_lexicon(spark):
    got = one_col(spark, ["great bread", "but slow", "really", "good but cold", "disappointing"], lexicon_score)
    assert [float(x) for x in got] == [1.0, -1.0, 0.0, 1.0, -1.0]


def test_week_bounds(spark):
    df = spark.createDataFrame([(date(2024, 5, 12),), (date(2024, 5, 13),)], "d date")
    got = [tuple(r) for r in df.select(week_start("d"), week_end("d")).collect()]
    assert got == [(date(2024, 5, 6), date(2024, 5, 12)), (date(2024, 5, 13), date(2024, 5, 19))]


def test_criticality(spark):
    assert one_col(spark, ["Cacao", "almonds", "flour", None, " cacao"], ingredient_criticality) == [5, 3, 2, 2, 2]


def test_mask_pii_sql_function(spark):
    from hearthlake.functions import register_sql_functions
    register_sql_functions(spark)
    row = spark.sql("SELECT mask_pii('abcdef', false) AS u, mask_pii('abcdef', true) AS a, "
                    "mask_pii(CAST(NULL AS STRING), false) AS n, mask_pii('a', false) AS s").first()
    assert (row.u, row.a, row.n, row.s) == ("ab***", "abcdef", None, "a***")


def test_mask_pii_with_one_argument_follows_the_session(spark):
    from hearthlake.functions import register_sql_functions
    register_sql_functions(spark)
    ask = lambda: tuple(spark.sql("SELECT mask_pii('abcdef'), mask_pii('abcdef', false), mask_pii(CAST(NULL AS STRING))").first())
    assert ask() == ("ab***", "ab***", None)
    spark.sql("SET VAR pii_admin = true")
    assert ask() == ("abcdef", "ab***", None)
    spark.sql("SET VAR pii_admin = false")
