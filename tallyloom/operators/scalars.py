"""One-row results inside larger plans."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_scalar(
    df: DataFrame, scalar: Column, body: Callable[[Column], Mapping[str, Column]]
) -> DataFrame:
    """Add the columns that `body` derives from a scalar subquery.

    The subquery stands in the plan once, however many expressions use its fields: nothing is
    collected to the driver program and nothing is cross-joined.
    """
    bound = df.withColumn("__scalar", scalar)
    return bound.withColumns(dict(body(F.col("__scalar")))).drop("__scalar")
