"""Number expressions: lenient casts, money text, safe ratios, tie-safe rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(15,2)"
QUANTITY = "decimal(15,3)"


def lenient(c: Column, kind: str) -> Column:
    """Cast that yields NULL where the value cannot be read (ANSI casts raise)."""
    return c.try_cast(kind)


def money_text(c: Column) -> Column:
    """``1 200,50 ₽`` -> 1200.50; text that is no number -> NULL."""
    plain = F.translate(c, ",₽ \u00a0\u2009\u202f", ".")
    return plain.try_cast(MONEY)


def safe_ratio(a: Column, b: Column) -> Column:
    """``a / b`` as double; NULL where ``b`` is zero or NULL."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def round_mean(c: Column, digits: int) -> Column:
    """Round a floating mean so that ties do not depend on summation order.

    A mean such as 2.675 may arrive as 2.67499999 or 2.67500001; the nudge
    is far below the kept digits and sends both the same way.
    """
    x = c.cast("double")
    return F.round(x + F.signum(x) * F.lit(1e-7), digits)


def sum_money(c: Column) -> Column:
    """Exact sum of a ``MONEY`` column, run on whole cents.

    Fifteen digits fit a double exactly, so the step to cents loses nothing.
    Long sums need no decimal arithmetic per row and a quarter of the shuffle
    bytes; a sum beyond a long raises.
    """
    cents = F.rint(c.cast(MONEY).cast("double") * 100).cast("bigint")
    return (F.sum(cents).cast("decimal(20,0)") / 100).cast("decimal(20,2)")


def clamp_min(c: Column, floor: int = 0) -> Column:
    """Values under ``floor`` become ``floor``; NULL stays NULL."""
    return F.when(c < floor, F.lit(floor)).otherwise(c)
