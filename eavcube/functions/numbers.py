"""Column expressions on measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: code for "no measurement" in the source series.
SENTINEL = -999.0


def to_number(c: Column) -> Column:
    """Text with a decimal comma or point to double; anything else, `nan` and `inf` included, to NULL.

    Other characters are looked for first: a failed cast costs far more, and a successful one would also
    accept a type suffix (`12d`).
    """
    text = F.trim(F.replace(c, F.lit(","), F.lit(".")))
    numeric = (F.translate(text, "0123456789+-.eE", "") == "") & (text != "")
    return F.when(numeric, text.try_cast("double"))


def to_integer(c: Column) -> Column:
    """Text to int, rounding a fraction half away from zero; anything else to NULL."""
    return F.round(to_number(c)).try_cast("int")


def sentinel_to_null(c: Column, sentinel: float = SENTINEL) -> Column:
    return F.nullif(c, F.lit(sentinel))


def clamp_negative(c: Column) -> Column:
    """Negative to zero; NULL stays NULL."""
    return F.when(c < 0, F.lit(0).cast("double")).otherwise(c)


def outside(c: Column, low: float, high: float) -> Column:
    """Not within the closed range; NULL is not outside."""
    return ~c.between(low, high)


def outside_box(lat: Column, lon: Column, box: Mapping[str, Sequence[float]]) -> Column:
    """Either coordinate outside its closed range (`box = {"lat": (lo, hi), "lon": (lo, hi)}`)."""
    return outside(lat, *box["lat"]) | outside(lon, *box["lon"])


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, NULL for a zero or missing divisor."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def normalised_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b); NULL when either is missing or negative or the sum is zero."""
    return F.when((a >= 0) & (b >= 0), safe_ratio(a - b, a + b))


def weighted_sum(weights: Mapping[str, float]) -> Column:
    """Sum of weight * column with missing values taken as zero."""
    return _total([F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(w) for c, w in weights.items()])


def row_sum(columns: Sequence[str]) -> Column:
    """Sum over columns of one row; missing values count as zero."""
    return _total([F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])


def row_mean(columns: Sequence[str]) -> Column:
    """Mean over the columns that have a value; NULL when none has."""
    known = _total([F.col(c).isNotNull().cast("int") for c in columns])
    return safe_ratio(row_sum(columns), known)


def _total(terms: Sequence[Column]) -> Column:
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total
