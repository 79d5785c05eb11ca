"""Linear models as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Probabilities are rounded before they are ranked, so that the last bits of
# exp() cannot change an order.
PLACES = 9


def margin(weights: Mapping[str, float], intercept: float) -> Column:
    total = F.lit(float(intercept))
    for name, weight in weights.items():
        total = total + F.lit(float(weight)) * F.col(name)
    return total


def logistic(m: Column) -> Column:
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-m)), PLACES)


def best_class(margins: Mapping[int, Column]) -> Column:
    """The class with the largest margin; the smaller class on a tie."""
    ranked = [
        F.struct(F.round(m, PLACES).alias("m"), F.lit(-c).alias("c"))
        for c, m in margins.items()
    ]
    return (-F.greatest(*ranked)["c"]).cast("int")
