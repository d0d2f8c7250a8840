"""Null-safe arithmetic and bracket expressions."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp(c, lo, hi) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (least/greatest alone would skip it)."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(lo))), F.lit(float(hi))))


def ratio(num, den) -> Column:
    """num/den, NULL on a zero denominator."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def share_or_zero(num, den) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def bracket(c, edges, labels, ordinal=False) -> Column:
    """Right-closed brackets (edge[i], edge[i+1]]; at or below the first edge, or NULL, gives NULL."""
    c = as_col(c)
    names = list(range(len(labels))) if ordinal else labels
    expr = F.when(c <= F.lit(edges[0]), F.lit(None))
    for upper, name in zip(edges[1:], names):
        expr = expr.when(c <= F.lit(upper), F.lit(name))
    return expr.when(c > F.lit(edges[-1]), F.lit(names[-1]))


def position_in(c, values) -> Column:
    """0-based position of a text in a fixed list, NULL if absent."""
    pairs = [F.lit(x) for i, v in enumerate(values) for x in (v, float(i))]
    return F.try_element_at(F.create_map(*pairs), as_col(c))


def ordered_hash(key, seed, digits: int = 15) -> Column:
    """A seeded 60-bit hash of a row key, ordered as the md5 text is."""
    text = F.md5(F.concat(as_col(key).cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(text, 1, digits), 16, 10).cast("long")


def round_exact(c, digits: int) -> Column:
    """A non-negative number at `digits` decimals, rounded by its exact binary value, ties to even.

    Rounding only the fraction keeps the digits that tell a true tie from a number just beside one.
    """
    c = as_col(c).cast("double")
    if digits == 0:
        return F.bround(c, 0)
    whole = F.floor(c).cast("double")
    return whole + F.bround(c - whole, digits)


def fixed_text(c, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", round_exact(c, digits))


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
