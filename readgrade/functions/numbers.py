"""Number expressions: repeatable rounding and digit strings."""

from pyspark.sql import Column, functions as F


def fixed(value: Column, digits: int) -> Column:
    """Round half up to ``digits`` decimals, the same way in every engine."""
    scale = float(10 ** digits)
    return F.floor(value * scale + 0.5).cast("double") / F.lit(scale)


def digits2(value: Column) -> Column:
    """``value`` with two decimals as text, built from whole numbers."""
    cents = F.floor(F.abs(value) * 100.0 + 0.5).cast("bigint")
    sign = F.when((value < 0) & (cents > 0), "-").otherwise("")
    whole = F.floor(cents / 100).cast("bigint").cast("string")
    return F.concat(sign, whole, F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))
