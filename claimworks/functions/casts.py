"""Casts that turn bad text into null, with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

WHOLE_PART = r"^\s*([+-]?[0-9]+)(?:[.][0-9]*)?\s*$"
WHOLE_NUMBER = r"^\s*([+-]?[0-9]+)(?:[.]0*)?\s*$"
NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"

# Texts that cast to true and false.
TRUE_WORDS = ("t", "true", "y", "yes", "1")
FALSE_WORDS = ("f", "false", "n", "no", "0")


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _digits(c: ColumnOrName, pattern: str, kind: str) -> Column:
    # A failing try_cast builds an exception per row, some forty times the cost
    # of this match, so only texts that fit get as far as the cast.
    digits = F.regexp_extract(as_column(c).cast("string"), pattern, 1)
    return F.nullif(digits, F.lit("")).try_cast(kind)


def lenient_int(c: ColumnOrName) -> Column:
    """Text to int; a decimal tail is cut off, anything else bad is null."""
    return _digits(c, WHOLE_PART, "int")


def lenient_long(c: ColumnOrName) -> Column:
    return _digits(c, WHOLE_PART, "bigint")


def decimal_or_null(c: ColumnOrName, precision: int = 10, scale: int = 2) -> Column:
    return as_column(c).try_cast(f"decimal({precision},{scale})")


def boolean_or_null(c: ColumnOrName) -> Column:
    """The words a cast takes for booleans, anything else null."""
    word = F.lower(F.btrim(as_column(c).cast("string"), F.lit(" \t\r\n")))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(
        word.isin(*FALSE_WORDS), F.lit(False)
    )


def double_or_null(c: ColumnOrName) -> Column:
    """Text to double; the text 'nan' is missing data, not a number."""
    number = as_column(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def whole_number(c: ColumnOrName) -> Column:
    """Any numeric text holding a whole number, '12.0' and '1e3' included."""
    text = as_column(c).cast("string")
    number = text.try_cast("double")
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    return F.coalesce(_digits(c, WHOLE_NUMBER, "bigint"), F.when(text.rlike(NUMBER), whole))


def date_from_epoch_days(c: ColumnOrName) -> Column:
    return F.date_from_unix_date(lenient_int(c))


def parse_timestamp(c: ColumnOrName, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.try_to_timestamp(as_column(c), F.lit(pattern)).cast("timestamp")


USUAL_DATES = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/M/d", "M/d/yyyy",
               "d MMM yyyy", "MMM d, yyyy", "yyyyMMdd")


def parse_date(c: ColumnOrName, *patterns: str) -> Column:
    """The first pattern that fits; by default ISO dates, with or without time, then other usual forms
    (month before day where both are numbers)."""
    tries = patterns or USUAL_DATES
    return F.coalesce(*[parse_timestamp(c, p).cast("date") for p in tries])


def boolean_from_words(c: ColumnOrName) -> Column:
    """Only the words true and false count, in any case."""
    word = F.lower(as_column(c).cast("string"))
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))
