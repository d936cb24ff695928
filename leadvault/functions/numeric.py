"""Flags, bands, scores and guarded ratios."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadvault.functions.text import _col

_COMPARE = {">=": operator.ge, ">": operator.gt, "<=": operator.le, "<": operator.lt, "=": operator.eq}


def flag(condition: Column) -> Column:
    """Boolean that is false where the condition is unknown."""
    return F.coalesce(condition, F.lit(False))


def flag01(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return flag(condition).cast("int")


def score(*conditions: Column) -> Column:
    """How many of the conditions hold."""
    return reduce(operator.add, [flag01(c) for c in conditions])


def band(c, bounds, default: str) -> Column:
    """Label of the first bound that holds; ``bounds`` lists (comparison, bound, label)."""
    value, out = _col(c), None
    for op, bound, label in bounds:
        test = _COMPARE[op](value, F.lit(bound))
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(default)


def ratio(num, den, scale: float = 1.0) -> Column:
    """``num * scale / den`` as a double, 0 where the denominator is not positive."""
    num, den = _col(num).cast("double"), _col(den).cast("double")
    return F.when(den > 0, num * F.lit(float(scale)) / den).otherwise(F.lit(0.0))


def any_positive(*metrics) -> Column:
    """True where at least one metric is above zero."""
    return flag(reduce(operator.or_, [F.coalesce(_col(m) > 0, F.lit(False)) for m in metrics]))


def all_present(*cols) -> Column:
    """True where none of the columns is NULL."""
    return reduce(operator.and_, [_col(c).isNotNull() for c in cols])


def exact_avg(c, scale: int = 6) -> Column:
    """Average whose sum does not depend on the order of the rows: summed as a decimal."""
    value = _col(c).cast(f"decimal(18,{scale})")
    return F.sum(value).cast("double") / F.count(value)
