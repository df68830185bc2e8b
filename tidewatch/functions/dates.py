"""Calendar columns in UTC; nothing here looks at the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The formats feeds use, most specific first.
FORMATS = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MMM d, yyyy, h:mm:ss a", "MM/dd/yyyy", "d MMM yyyy")


def any_date(text: Column) -> Column:
    """The date of a text in any known format, else null."""
    plain = F.regexp_replace(F.trim(text), r"\.\d+", "")
    return F.coalesce(*[F.to_date(F.try_to_timestamp(plain, F.lit(f))) for f in FORMATS])


def iso_monday(day: Column) -> Column:
    return F.to_date(F.date_trunc("week", day))


def half_year(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.when(F.month(day) <= 6, "H1").otherwise("H2"))


def last_complete_month(day: Column) -> Column:
    """First day of the last month that ended by ``day``."""
    return F.add_months(F.trunc(F.date_add(day, 1), "month"), -1)


def coarse_window(text: Column) -> Column:
    """(lo, hi) of a year or year-month, with a month of spill-over on both sides."""
    year, month = F.regexp_extract(text, r"^(\d{4})$", 1), F.regexp_extract(text, r"^(\d{4}-\d{2})$", 1)
    lo = F.coalesce(F.try_to_date(F.concat(F.when(month != "", month), F.lit("-01"))), F.try_to_date(F.concat(F.when(year != "", year), F.lit("-01-01"))))
    span = F.when(month != "", 1).otherwise(12)
    return F.struct(F.add_months(lo, -1).alias("lo"), F.date_sub(F.add_months(lo, span + 1), 1).alias("hi"))


def date_chunks(lo: Column, hi: Column, days: int = 120) -> Column:
    """Consecutive windows of at most ``days`` days that cover lo to hi."""
    starts = F.sequence(lo, hi, F.expr(f"interval {days} days"))
    return F.transform(starts, lambda s: F.struct(s.alias("lo"), F.least(F.date_add(s, days - 1), hi).alias("hi")))
