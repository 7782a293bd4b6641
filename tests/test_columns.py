from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillroll.functions import columns as C


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "layout", "expected"),
    [
        ("2010-12-01 08:26:00", C.ISO_LAYOUT, datetime(2010, 12, 1, 8, 26)),
        ("12/1/2010 8:26", C.US_LAYOUT, datetime(2010, 12, 1, 8, 26)),
        ("12/1/2010 8:26", C.ISO_LAYOUT, None),
        ("not a date", C.ISO_LAYOUT, None),
        ("12/1/2010 8:26", C.ANY_LAYOUT, datetime(2010, 12, 1, 8, 26)),
        ("not a date", C.ANY_LAYOUT, None),
    ],
)
def test_times_that_do_not_fit_the_layout_are_null(spark, text, layout, expected):
    assert value(spark, C.parse_time(F.lit(text), layout)) == expected


@pytest.mark.parametrize(("customer", "label"), [(17850.0, "17850"), (None, "unknown"), (3e10, "30000000000")])
def test_customer_labels(spark, customer, label):
    assert value(spark, C.customer_or_unknown(F.lit(customer).cast("double"))) == label


@pytest.mark.parametrize(
    ("day", "locale", "name"),
    [(1, "vi", "Chủ nhật"), (7, "en", "Saturday"), (2, "vi-short", "T2"), (9, "vi", "Unknown"), (9, "en", None)],
)
def test_weekday_names(spark, day, locale, name):
    assert value(spark, C.weekday_name(F.lit(day), locale)) == name


def test_sunday_is_day_one(spark):
    moment = F.lit("2010-12-05 23:59:00").cast("timestamp")
    parts = {name: value(spark, part) for name, part in C.calendar_of(moment).items()}
    assert parts == {"Year": 2010, "Month": 12, "DayOfWeek": 1, "Hour": 23}


@pytest.mark.parametrize(("number", "rounded"), [("2.345", 2.35), ("-2.345", -2.35), ("1.005", 1.01), ("0.004", 0.0)])
def test_rounding_is_half_up_on_exact_decimals(spark, number, rounded):
    assert value(spark, C.as_double(F.lit(number).cast("decimal(18,4)"))) == rounded


def test_half_cent_amounts_use_the_unrounded_price(spark):
    amount = F.round(C.line_amount(F.lit(3), F.lit(0.125)), 2)
    assert float(value(spark, amount)) == 0.38


def test_ratio_guards_zero(spark):
    assert value(spark, C.ratio(F.lit("1.00").cast("decimal(18,2)"), F.lit(0))) is None


def test_percent_of_nothing_is_zero(spark):
    assert value(spark, C.percent(F.lit(0), F.lit(0))) == 0.0
    assert value(spark, C.percent(F.lit(1), F.lit(3))) == 33.3


@pytest.mark.parametrize(
    ("expression", "expected"),
    [
        (lambda: C.month_label(F.lit(2011), F.lit(3)), "2011-03"),
        (lambda: C.month_label(F.lit(None).cast("int"), F.lit(3)), "N/A"),
        (lambda: C.hour_label(F.lit(8)), "8:00"),
        (lambda: C.shorten(F.lit("a" * 36), 35), "a" * 35 + "..."),
        (lambda: C.shorten(F.lit("a" * 35), 35), "a" * 35),
        (lambda: C.shorten(F.lit(None).cast("string"), 35), "N/A"),
        (lambda: C.slug(F.lit("Lost Customers")), "lost-customers"),
        (lambda: C.slug(F.lit(None).cast("string")), "regular"),
        (lambda: C.score_digits(F.lit(5), F.lit(4), F.lit(3)), "543"),
        (lambda: C.within_scale(F.lit(7)), 5),
        (lambda: C.within_scale(F.lit(0)), 1),
        (lambda: C.tidy_text(F.lit("  red mug ")), "RED MUG"),
    ],
)
def test_labels(spark, expression, expected):
    assert value(spark, expression()) == expected


def test_elapsed_days_are_truncated_but_calendar_days_are_not(spark):
    late, early = (F.lit(t).cast("timestamp") for t in ("2010-12-03 23:50:00", "2010-12-04 00:10:00"))
    assert value(spark, C.whole_days_between(late, early)) == 0
    assert value(spark, F.datediff(early, late)) == 1
