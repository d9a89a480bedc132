"""Check-digit validation of ten-digit identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docspark.functions.text import strip
from docspark.vocab import IDENTIFIER_PREFIX


def is_ten_digits(c: Column) -> Column:
    return F.coalesce(strip(c).rlike("^[0-9]{10}$"), F.lit(False))


def identifier_reason(c: Column) -> Column:
    """Why an identifier is accepted or refused."""
    full = F.concat(F.lit(IDENTIFIER_PREFIX), strip(c))
    return (
        F.when(~is_ten_digits(c), F.lit("Not exactly 10 digits"))
        .when(F.call_function("luhn_check", full), F.lit("Luhn check passed"))
        .otherwise(F.lit("Luhn check failed"))
    )


def is_valid_identifier(c: Column) -> Column:
    return is_ten_digits(c) & F.call_function("luhn_check", F.concat(F.lit(IDENTIFIER_PREFIX), strip(c)))
