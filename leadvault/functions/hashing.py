"""Business keys, identity hashes and change hashes. All are MD5 as 32 lower-case hex digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadvault.functions.text import _col, digits, strip

# Fixed value: stands for NULL in a surrogate key.
_SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def hash_key(*parts, upper: bool = False) -> Column:
    """Hash of business-key parts joined by ``|``; NULL if any part is NULL.

    ``upper`` strips and upper-cases the parts first, for keys typed in by people."""
    cols = [_col(p).cast("string") for p in parts]
    if upper:
        cols = [F.upper(strip(c)) for c in cols]
    joined = [cols[0]]
    for c in cols[1:]:
        joined += [F.lit("|"), c]
    return F.md5(F.concat(*joined))


def hash_diff(*cols) -> Column:
    """Hash of an attribute list, NULL counted as empty: equal hashes mean nothing changed."""
    return F.md5(F.concat_ws("|", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]))


def surrogate_key(*cols) -> Column:
    """Hash of a column list, NULL told apart from empty."""
    return F.md5(F.concat_ws("-", *[F.coalesce(_col(c).cast("string"), F.lit(_SURROGATE_NULL)) for c in cols]))


def person_hash(name, email, phone) -> Column:
    """Identity hash over whichever of name, e-mail and phone are present.

    An e-mail identifies a person alone or together with the other two; without it, name and
    phone are both needed. Anything less has no identity and gives NULL. The present parts are
    normalised and joined by ``|`` in the order name, e-mail, phone."""
    name, email, phone = _col(name), _col(email), _col(phone)
    identified = email.isNotNull() | (name.isNotNull() & phone.isNotNull())
    parts = F.concat_ws("|", F.lower(strip(name)), F.lower(strip(email)), digits(phone))
    return F.when(identified, F.md5(parts))
