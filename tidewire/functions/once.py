"""Evaluate a costly expression once per row."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(col: Column) -> Column:
    """The same value, as the explode of one element.

    Spark moves filters below a plain projection and repeats its expressions there. It does not move them below an
    explode, so a parse or a long formula that is filtered on later runs only once.
    """
    return F.explode(F.array(col))
