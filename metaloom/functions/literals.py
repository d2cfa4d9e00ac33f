"""Constant tables inside expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_map(pairs) -> Column:
    """A constant string map, written as one literal: the optimizer folds it once, and the plan
    does not grow with its entries."""
    text = "\u0001".join(f"{key}\u0002{value}" for key, value in pairs.items())
    return F.str_to_map(F.lit(text), F.lit("\u0001"), F.lit("\u0002"))
