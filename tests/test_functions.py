import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from filmlake.functions import awards, dates, lists, money, text


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("+2001-05-17T00:00:00Z", dt.date(2001, 5, 17)),
        ("+2001-05-00T00:00:00Z", dt.date(2001, 5, 1)),
        ("+2001-00-00T00:00:00Z", dt.date(2001, 1, 1)),
        ("+2001-00-15T00:00:00Z", dt.date(2001, 1, 1)),
        ("+2001-02-30T00:00:00Z", dt.date(2001, 2, 1)),
        ("-0044-03-15T00:00:00Z", None),
        ("+0000-01-01T00:00:00Z", None),
        ("2001", None),
    ],
)
def test_partial_date(spark, raw, expected):
    assert one(spark, dates.partial_date(F.col("d")), d=raw) == expected


def test_earliest_date(spark):
    column = dates.earliest_date(F.array(F.lit("+1999-05-00T00:00:00Z"), F.lit("+1998-12-31T00:00:00Z")))
    assert one(spark, column) == dt.date(1998, 12, 31)


def test_year_and_epoch_ignore_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Vancouver")
    try:
        assert one(spark, dates.iso_epoch(F.lit("1970-01-02"))) == 86400
        assert one(spark, dates.iso_year(F.lit("1927-03-06"))) == 1927
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "summary, points",
    [
        ("Won 3 Oscars. Another 45 wins & 60 nominations.", 90.0),
        ("Nominated for 2 Oscars. Another 5 wins & 8 nominations.", 17.0),
        ("Won 1 Golden Globe. Another 2 wins.", 9.0),
        ("Nominated for 1 Golden Globe. Another 4 nominations.", 4.0),
        ("3 nominations.", 0.75),
        ("N/A", 0.0),
        (None, 0.0),
    ],
)
def test_awards_score(spark, summary, points):
    assert one(spark, awards.awards_score(F.col("a").cast("string")), a=summary) == points


def test_early_awards_weights(spark):
    column = awards.awards_score(F.lit("Won 3 Oscars. Another 45 wins & 60 nominations."), awards.EARLY_AWARD_WEIGHTS)
    assert one(spark, column) == 15 + 45 + 15


@pytest.mark.parametrize("year, worth", [(2018, 102.97), (2019, 100.0), (2017, 106.028209)])
def test_inflation(spark, year, worth):
    assert math.isclose(one(spark, F.lit(100.0) * money.money_value(F.lit(year))), worth, rel_tol=1e-9)


def test_profit_flags(spark):
    assert one(spark, money.made_profit(F.lit(2.0), F.lit(1.0))) is True
    assert one(spark, money.made_profit(F.lit(2.0), F.lit(None).cast("double"))) is None
    assert one(spark, money.profit_rate(F.lit(2.0), F.lit(0.0))) is None


def test_clean_text(spark):
    assert one(spark, text.clean_text(F.lit("Don't stop -- it's 1999!"))) == "dont stop its"
    assert one(spark, text.clean_tokens(text.clean_text(F.lit(" 1999 ")))) == []


def test_tokens(spark):
    assert one(spark, text.word_tokens(F.lit("Été déjà_vu, a 12 it's"))) == ["été", "déjà_vu", "a", "12", "it", "s"]
    assert one(spark, text.long_word_tokens(F.lit("a bb c_d"))) == ["bb", "c_d"]
    kept = text.join_tokens(text.without_words(F.split(F.lit("the cat the end"), " "), ["the"]))
    assert one(spark, kept) == "cat end"


def test_lists(spark):
    empty = F.array().cast("array<string>")
    assert one(spark, lists.first_item(empty)) is None
    assert one(spark, lists.first_n(F.split(F.lit("a b c"), " "), 2)) == ["a", "b"]
    assert one(spark, lists.first_n(F.split(F.lit("a"), " "), 2)) == ["a"]
    assert one(spark, lists.as_list(F.lit("x"))) == ["x"]
    assert one(spark, lists.as_list(F.lit(None).cast("string"))) is None
    assert one(spark, lists.split_labels(F.lit("Drama, War"))) == ["Drama", "War"]
