"""Column expressions on text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefix of the home state and width of a place key.
HOME_PREFIX = "15"
PLACE_WIDTH = 5


def zero_fill(c: Column, width: int = PLACE_WIDTH) -> Column:
    """Left-pad the trimmed text with zeros; longer text is kept whole."""
    text = F.trim(c.cast("string"))
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def repair_short_key(c: Column, prefix: str = HOME_PREFIX, width: int = PLACE_WIDTH) -> Column:
    """Rebuild a key that lost its state prefix: the last two characters are dropped, the rest is padded."""
    body = F.substr(c, F.lit(1), F.greatest(F.length(c) - 2, F.lit(0)))
    return F.when(
        F.length(c) < width, F.concat(F.lit(prefix), F.lpad(body, width - len(prefix), "0"))
    ).otherwise(c)


def is_inverted_key(c: Column, prefix: str = HOME_PREFIX, width: int = PLACE_WIDTH) -> Column:
    """The state prefix stands at the end of the key."""
    return c.endswith(prefix) & ~c.startswith(prefix) & (F.length(c) == width)


def swap_inverted_key(c: Column, prefix: str = HOME_PREFIX, width: int = PLACE_WIDTH) -> Column:
    """Move a trailing state prefix to the front (`10215` to `15102`)."""
    head = width - len(prefix)
    swapped = F.concat(F.substring(c, head + 1, len(prefix)), F.substring(c, 1, head))
    return F.when(is_inverted_key(c, prefix, width), swapped).otherwise(c)
