"""Date normalisation to ISO text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docspark.functions.text import let

# fixed values: accepted shapes of a full date
ISO_DATE = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
US_DATE = r"[0-9]{1,2}[/.-][0-9]{1,2}[/.-][0-9]{4}"
SHORT_DATE = r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}"
MONTH_FIRST = r"[A-Za-z]{3,9}\.? [0-9]{1,2},? [0-9]{4}"
DAY_FIRST = r"[0-9]{1,2}[ -][A-Za-z]{3,9}\.?[ -][0-9]{4}"

# no digit, and no further part of a number or date, may stand right before or behind
_ANY_DATE = f"(?<![0-9A-Za-z])(?<![0-9][/.-])({ISO_DATE}|{US_DATE}|{SHORT_DATE}|{MONTH_FIRST}|{DAY_FIRST})(?![0-9])(?![/.-][0-9])"
_NAMED = r"^(?:([0-9]{1,2})[ -])?([A-Za-z]{3})[A-Za-z]*\.?(?: ([0-9]{1,2}),?)?[ -]([0-9]{4})$"

#: Two-digit years from here on are of the last century.
CENTURY_CUT = 76


def date_text(c: Column) -> Column:
    """The first part of a text that looks like a full date, else null.

    Whatever stands around it is left out: time of day, zone, a sex letter.
    """
    return F.nullif(F.regexp_extract(c, _ANY_DATE, 1), F.lit(""))


def to_iso_date(c: Column) -> Column:
    """ISO ``yyyy-MM-dd`` text of the date in ``c``; null if none or impossible.

    The time and the zone never shift the day. A partial date is null. Of
    numbers, the month comes first, unless only the other order is a date.
    """

    def either(d: Column) -> Column:
        return F.coalesce(F.try_to_date(d, "M/d/yyyy"), F.try_to_date(d, "d/M/yyyy"))

    def century(year: Column) -> Column:
        return F.when(year.cast("int") < CENTURY_CUT, F.lit("20")).otherwise(F.lit("19"))

    def parse(d: Column) -> Column:
        named = F.initcap(F.regexp_replace(d, _NAMED, "$2 $1$3 $4"))
        return F.date_format(
            F.when(d.rlike("^" + ISO_DATE), F.try_to_date(d, "yyyy-M-d"))
            .when(d.rlike("^" + US_DATE), either(F.translate(d, ".-", "//")))
            .when(d.rlike("^" + SHORT_DATE), either(F.concat(F.left(d, F.length(d) - 2), century(F.right(d, F.lit(2))), F.right(d, F.lit(2)))))
            .when(d.isNotNull(), F.try_to_date(named, "MMM d yyyy")),
            "yyyy-MM-dd",
        )

    return let(date_text(c), parse)
