"""Text rules: names, addresses, file names, null tokens."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import ColumnOrName, as_column

# The patterns file names are read with.
IMAGE_FILE = r".*\.(jpg|jpeg|png)$"
IMAGE_NAME = r".*/(.*?.jpg)"
IMAGE_NAME_STRICT = r"([^/]+\.(?:[jJ][pP][eE]?[gG]|[pP][nN][gG]))$"
TRAINING_LABEL = r"/(\d+)-([a-zA-Z]+)(?: \(\d+\))?\.png$"

# The texts a CSV reader takes for null.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

WHITESPACE = " \t\r\n\f\x0b"


def strip(c: ColumnOrName) -> Column:
    return F.btrim(as_column(c), F.lit(WHITESPACE))


def null_if_token(c: ColumnOrName, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    c = as_column(c)
    return F.when(~c.isin(*tokens), c)


def clean_name(c: ColumnOrName) -> Column:
    """Trim, drop the outer quotes, remove commas."""
    return F.translate(F.btrim(strip(c), F.lit('"')), ",", "")


def name_part(c: ColumnOrName, index: int) -> Column:
    return F.get(F.split(as_column(c), " "), F.lit(index))


def join_address(*parts: ColumnOrName) -> Column:
    """Comma-joined parts; missing parts are skipped, so never null."""
    return F.concat_ws(", ", *[as_column(p) for p in parts])


def is_image_path(c: ColumnOrName) -> Column:
    return F.lower(as_column(c)).rlike(IMAGE_FILE)


def image_name(c: ColumnOrName, strict: bool = False) -> Column:
    """File name of a claim image, '' if the path has none.

    The default keeps the loose lower-case jpg rule; ``strict`` takes every
    admitted extension in any case and gives null where nothing fits.
    """
    if not strict:
        return F.regexp_extract(as_column(c), IMAGE_NAME, 1)
    found = F.regexp_extract(as_column(c), IMAGE_NAME_STRICT, 1)
    return F.when(found != "", found)


def training_label(c: ColumnOrName) -> Column:
    return F.regexp_extract(as_column(c), TRAINING_LABEL, 2)
