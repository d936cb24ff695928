"""Text cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's one-argument trim removes the space character only.
_WHITESPACE = " \t\n\r\f\x0b"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove leading and trailing white space, tabs and line ends included."""
    return F.btrim(_col(c), F.lit(_WHITESPACE))


def clean_upper(c) -> Column:
    """Upper case, stripped; NULL becomes the empty string."""
    return strip(F.upper(F.coalesce(_col(c), F.lit(""))))


def clean_lower(c) -> Column:
    """Lower case, stripped; NULL stays NULL."""
    return strip(F.lower(_col(c)))


def blank_to_null(c) -> Column:
    """Stripped text, with NULL for text that holds nothing else than white space."""
    return F.nullif(strip(c), F.lit(""))


def digits(c) -> Column:
    """Only the digits 0-9 of the text."""
    return F.regexp_replace(_col(c), "[^0-9]", "")


def non_blank(c) -> Column:
    """True where the text is present and not empty; never NULL."""
    return F.coalesce(_col(c) != "", F.lit(False))


def not_sentinel(c, values=("unknown",)) -> Column:
    """True where the text is present, not empty and not one of the placeholder values."""
    return non_blank(c) & ~F.coalesce(_col(c).isin(*values), F.lit(False))


def first_usable(*candidates, sentinels=("unknown",), default: str | None = None) -> Column:
    """First candidate that is neither NULL, empty nor a placeholder."""
    usable = [F.when(not_sentinel(c, sentinels), _col(c)) for c in candidates]
    if default is not None:
        usable.append(F.lit(default))
    return F.coalesce(*usable)


def tagged_name(tags, prefix: str) -> Column:
    """The name behind the first ``<prefix>_<name>`` tag; empty where no tag matches."""
    return F.regexp_extract(_col(tags), prefix + "_([a-zA-Z0-9_]+)", 1)


def json_fields(c, names) -> Column:
    """Struct of the named string members of a JSON object. The text is parsed once per row,
    however many members are read from it."""
    return F.from_json(_col(c), ", ".join(f"`{n}` string" for n in names))


def concat_all(*parts) -> Column:
    """Join parts; NULL if any part is NULL."""
    return reduce(F.concat, [_col(p) for p in parts])
