"""Column expressions on text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and what each is folded to, then the label for a missing text.
ACCENTED = "áÁéÉíÍóÓúÚüÜñÑ"
FOLDED = "aaeeiioouuuunn"
UNSPECIFIED = "no especificado"
WHITESPACE = " \t\n\r\f\v\u00a0"

# Wording of a size class and the midpoint in hectares that stands for it.
SIZE_MIDPOINTS = {
    "0 a 5": 2.5,
    "6 a 10": 8.0,
    "11 a 20": 15.0,
    "21 a 50": 35.0,
    "51 a 100": 75.0,
    "Mayor a 100": 150.0,
}


def fold_accents(c: Column) -> Column:
    return F.translate(c, ACCENTED, FOLDED)


def normalise_text(c: Column, missing: str = UNSPECIFIED) -> Column:
    """Plain lower-case text without outer spaces; NULL becomes the `missing` label."""
    return F.coalesce(F.lower(F.trim(fold_accents(c))), F.lit(missing))


def strip_whitespace(c: Column) -> Column:
    """Remove every whitespace character, inner ones too."""
    return F.regexp_replace(c, r"\s", "")


def trim_whitespace(c: Column) -> Column:
    """Remove outer whitespace of any kind (`trim` alone removes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def first_token(c: Column, separator: str = " ") -> Column:
    return F.split_part(c, F.lit(separator), F.lit(1))


def has_accents(c: Column) -> Column:
    return c.rlike(f"[{ACCENTED}]")


def is_untrimmed(c: Column) -> Column:
    return c != F.trim(c)


def is_mixed_case(c: Column) -> Column:
    return (c != F.upper(c)) & (c != F.lower(c))


def keyword_weight(c: Column, weights: Mapping[str, float], default: float) -> Column:
    """Weight of the first keyword found in the text, ignoring case."""
    return _first_match(F.lower(c), {k.lower(): v for k, v in weights.items()}, F.lit(float(default)))


def size_midpoint(c: Column, midpoints: Mapping[str, float] = SIZE_MIDPOINTS) -> Column:
    """Numeric midpoint of a size-class label; unknown labels give NULL."""
    return _first_match(F.lower(c), {k.lower(): v for k, v in midpoints.items()}, F.lit(None).cast("double"))


def repair_size_label(c: Column) -> Column:
    return F.replace(c, F.lit("06 a 10"), F.lit("6 a 10"))


def map_labels(c: Column, labels: Mapping) -> Column:
    """Look a value up in a small fixed mapping; values outside it give NULL."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), c)


def _first_match(text: Column, table: Mapping[str, float], otherwise: Column) -> Column:
    cases = None
    for word, weight in table.items():
        hit = text.contains(word)
        cases = F.when(hit, F.lit(float(weight))) if cases is None else cases.when(hit, F.lit(float(weight)))
    return otherwise if cases is None else cases.otherwise(otherwise)
