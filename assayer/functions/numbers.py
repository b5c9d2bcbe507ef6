"""Numbers in text, and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: More digits than this are refused, so that sums stay within DECIMAL(38, 0).
MAX_TOKEN_DIGITS = 30


def parse_ordinal(c: Column) -> Column:
    """Digits with an optional sign, single underscores between digits allowed; else null."""
    return F.when(c.rlike(r"\A[+-]?[0-9]+(_[0-9]+)*\z"), F.replace(c, F.lit("_"), F.lit("")).try_cast("bigint"))


def parse_seconds(c: Column) -> Column:
    """A finite decimal number of at least 0; else null. Words, hex and type suffixes are refused."""
    digits = r"[0-9]+(_[0-9]+)*"
    number = F.when(c.rlike(rf"\A[+-]?({digits}(\.({digits})?)?|\.{digits})([eE][+-]?{digits})?\z"), F.replace(c, F.lit("_"), F.lit("")).try_cast("double"))
    return F.when((number >= 0) & (number < float("inf")), number)


def parse_tokens(c: Column) -> Column:
    """ASCII digits alone, MAX_TOKEN_DIGITS at most; else null."""
    return F.when(c.rlike(rf"\A[0-9]{{1,{MAX_TOKEN_DIGITS}}}\z"), c.try_cast("decimal(38,0)"))


def parse_score(c: Column) -> Column:
    """An item's score: an integer text, or a JSON number cut towards zero; else null."""
    whole = parse_ordinal(c)
    return F.coalesce(whole, F.when(c.rlike(r"\A-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?\z"), c.try_cast("double").try_cast("bigint")))


def task_score(earned: Column, total: Column, most: int = 5) -> Column:
    """most x earned / total, 0 if nothing can be earned; negative sums count 0. Not rounded."""
    return F.when(total <= 0, F.lit(0.0)).otherwise(F.lit(most) * F.greatest(F.lit(0), earned) / total).cast("double")


def rounded(c: Column, places: int) -> Column:
    """Half-even in the JVM, on the decimal rendering."""
    return F.bround(c, places)


#: 2^27 + 1, which parts a double in two halves whose products are exact.
_HALVES = 134217729.0


def _halves(x: float) -> tuple[float, float]:
    high = _HALVES * x - (_HALVES * x - x)
    return high, x - high


def round_exact(c: Column, places: int) -> Column:
    """Half-even on the exact binary value, in the JVM; places from 0 to 22.

    The product with 10^places is taken without error, as a double and what it lacks, so that its distance from the
    middle between two integers has the right sign; the integer over 10^places is then the nearest double. Numbers of
    2^51 / 10^places or more, beyond which halves are lost, are rounded on their decimal rendering."""
    scale = float(10**places)
    high, low = _halves(scale)
    x = F.abs(c)
    product = x * scale
    split = x * _HALVES
    x_high = split - (split - x)
    x_low = x - x_high
    lacks = ((x_high * high - product) + x_high * low + x_low * high) + x_low * low
    whole = F.floor(product).cast("double")
    beyond = ((product - whole) - 0.5) + lacks
    up = (beyond > 0) | ((beyond == 0) & (whole % 2 == 1))
    near = F.when(up, whole + 1).otherwise(whole) / scale
    signed = F.when(c < 0, -near).otherwise(near)
    return F.when(F.isnan(c) | (product >= float(1 << 51)), F.bround(c, places)).when(c == 0, c).otherwise(signed)  # 0 keeps its sign
