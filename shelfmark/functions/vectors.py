"""Vector arithmetic on array columns, evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def inner_product(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_normalize(vector: Column) -> Column:
    """Unit vector; a zero vector stays as it is."""
    # The norm goes in as a second array: inside the lambda it would be computed per element.
    norm = F.sqrt(inner_product(vector, vector))
    divisors = F.array_repeat(F.when(norm > 0, norm).otherwise(F.lit(1.0)), F.size(vector))
    return F.zip_with(vector, divisors, lambda x, n: x.cast("double") / n)
