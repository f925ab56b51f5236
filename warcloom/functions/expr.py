"""Small building blocks shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every character up to and including the space.
_BLANKS = "".join(chr(c) for c in range(0x21))


def trim_blanks(text: Column) -> Column:
    """Strip control characters and spaces from both ends.

    ``F.trim`` strips spaces only.
    """
    return F.btrim(text, F.lit(_BLANKS))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``.

    Lambdas re-evaluate the outer expressions they mention for every element;
    binding them to a lambda variable first avoids that.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def raw_text(data: Column) -> Column:
    """View bytes as a string without decoding, so byte-wise string functions apply."""
    return data.cast("string")


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters use.

    Filters are pushed below a plain column by copying its expression into them,
    which would then run again for every mention. They are not pushed through
    this one-row ``explode``.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
