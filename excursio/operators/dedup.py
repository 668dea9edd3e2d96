"""Keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_PLACE = "__place"


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the earliest by ``order_by`` (NULLs last).

    Ties go to the copy with the fewest missing values, then to the smallest values in column
    order, so the answer does not depend on how rows arrive. Spark keeps the first row of a key
    on both sides of the shuffle, so a key whose copies make up a third of the table sends one
    row per task instead of gathering all copies in one sort.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    missing = reduce(add, [F.col(c).isNull().cast("int") for c in rest], F.lit(0))
    order = [*[F.asc_nulls_last(c) for c in order_by], missing, *rest]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_PLACE, first).filter(F.col(_PLACE) == 1).drop(_PLACE)
