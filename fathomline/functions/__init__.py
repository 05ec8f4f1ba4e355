"""Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(x) -> Column:
    """A name, value or Column as a double."""
    return (F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)).cast("double")


def let(value: Column, use) -> Column:
    """use(value), with value computed once however often use names it: inside higher-order functions Spark shares nothing."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
