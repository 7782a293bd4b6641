"""Reusable column expressions (F1-F21, P11, P12). All are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.schema import PRICE

UNKNOWN = "unknown"

# Weekday labels by Spark day number (1 = Sunday), and the label of any other number.
WEEKDAYS = {
    "vi": ("Chủ nhật", "Thứ hai", "Thứ ba", "Thứ tư", "Thứ năm", "Thứ sáu", "Thứ bảy"),
    "en": ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"),
    "vi-short": ("CN", "T2", "T3", "T4", "T5", "T6", "T7"),
}
NO_WEEKDAY = {"vi": "Unknown", "en": None, "vi-short": "N/A"}

# Timestamp layouts met in invoice files.
ISO_LAYOUT = "yyyy-MM-dd HH:mm:ss"
US_LAYOUT = "M/d/yyyy H:mm"


ANY_LAYOUT = (ISO_LAYOUT, US_LAYOUT)


def parse_time(text: Column, layout: str | Sequence[str] = ISO_LAYOUT) -> Column:
    """Text to timestamp (F1, F2), by the first layout that fits.

    Text that fits none becomes null instead of failing the job.
    """
    layouts = [layout] if isinstance(layout, str) else layout
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(one)) for one in layouts])


def customer_text(customer: Column) -> Column:
    """Customer id as text without a decimal part (F11); null stays null.

    Numbers lose their decimal part. Text keeps what it says, but for outer blanks and an ending ``.0``; blank text is null.
    """
    text = F.regexp_replace(F.trim(customer.cast("string")), r"^(\d+)\.0+$", "$1")
    number = customer.try_cast("double").try_cast("bigint").cast("string")
    return F.when(F.typeof(customer) == "string", F.nullif(text, F.lit(""))).otherwise(number)


def customer_or_unknown(customer: Column) -> Column:
    """Customer number as text, with one shared label for the missing ones."""
    return F.coalesce(customer_text(customer), F.lit(UNKNOWN))


def is_cancelled(invoice: Column) -> Column:
    """Cancelled invoices carry the prefix C."""
    return invoice.startswith("C")


def calendar_of(moment: Column) -> dict[str, Column]:
    """Year, month, weekday (1 = Sunday) and hour of a timestamp."""
    return {
        "Year": F.year(moment),
        "Month": F.month(moment),
        "DayOfWeek": F.dayofweek(moment),
        "Hour": F.hour(moment),
    }


def line_amount(quantity: Column, price: Column) -> Column:
    """Quantity times unit price, exact to ten places of the price."""
    return quantity.cast("decimal(10,0)") * price.cast(PRICE)


def tidy_text(text: Column) -> Column:
    """Upper case without outer blanks."""
    return F.trim(F.upper(text))


def weekday_name(day: Column, locale: str = "vi") -> Column:
    """Weekday number to its label in a locale."""
    pairs = [F.lit(v) for n, name in enumerate(WEEKDAYS[locale], start=1) for v in (n, name)]
    name = F.element_at(F.create_map(*pairs), day)
    default = NO_WEEKDAY[locale]
    return name if default is None else F.coalesce(name, F.lit(default))


def as_double(value: Column, digits: int = 2) -> Column:
    """Round half up on the exact decimal, then leave as double (F8)."""
    return F.round(value, digits).cast("double")


def ratio(total: Column, count: Column, digits: int = 2) -> Column:
    """Rounded quotient; a zero or null divisor gives null."""
    return as_double(total / F.nullif(count, F.lit(0)), digits)


def count_ratio(total: Column, count: Column, digits: int = 2) -> Column:
    """Rounded quotient of two whole numbers, divided as decimals so that half-way cases stay exact."""
    return ratio(total.cast("decimal(20,0)"), count.cast("decimal(18,0)"), digits)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Share of a whole in percent; 0 when the whole is not positive."""
    share = part.cast("decimal(20,2)") * 100 / whole.cast("decimal(18,2)")
    return F.when(whole > 0, as_double(share, digits)).otherwise(F.lit(0.0))


def month_label(year: Column, month: Column) -> Column:
    """YYYY-MM (F19)."""
    return F.when(year.isNotNull() & month.isNotNull(), F.format_string("%d-%02d", year, month)).otherwise("N/A")


def hour_label(hour: Column) -> Column:
    """H:00 (F19)."""
    return F.coalesce(F.concat(hour.cast("string"), F.lit(":00")), F.lit("N/A"))


def shorten(text: Column, width: int) -> Column:
    """The first ``width`` characters, with three dots when something was cut; N/A for missing text."""
    cut = F.concat(F.substring(text, 1, width), F.lit("..."))
    return F.when(F.length(text) > width, cut).otherwise(F.coalesce(F.when(text != "", text), F.lit("N/A")))


def slug(label: Column) -> Column:
    """Lower case with dashes for blanks; missing labels are 'regular' (F21)."""
    return F.coalesce(F.replace(F.lower(label), F.lit(" "), F.lit("-")), F.lit("regular"))


def whole_days_between(earlier: Column, later: Column) -> Column:
    """Elapsed time in whole days, truncated."""
    return F.floor((F.unix_timestamp(later) - F.unix_timestamp(earlier)) / 86400).cast("int")


def score_digits(*scores: Column) -> Column:
    """Scores written side by side, e.g. 543."""
    return F.concat(*[s.cast("string") for s in scores])


def within_scale(score: Column, low: int = 1, high: int = 5) -> Column:
    """Clamp a score."""
    return F.greatest(F.lit(low), F.least(F.lit(high), score))
