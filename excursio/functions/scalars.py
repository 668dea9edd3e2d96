"""Small column helpers: ids, lookups, clamps, column-wide casts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def make_id(prefix: str, number: Column, width: int = 0) -> Column:
    """Prefix plus number, zero-padded to ``width``; longer numbers keep all digits."""
    digits = number.cast("string")
    if width:
        digits = F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))
    return F.concat(F.lit(prefix), digits)


def id_number(identifier: Column, prefix_length: int) -> Column:
    """Numeric suffix of an id, NULL when it is not a number."""
    return F.substr(identifier, F.lit(prefix_length + 1)).try_cast("bigint")


def lookup(values: Mapping, key: Column, default) -> Column:
    """Constant lookup; keys outside the table give ``default``."""
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def position_in(values: Sequence[str], column: Column) -> Column:
    """1-based position in a fixed order; NULL for a value outside it."""
    place = F.array_position(F.array(*[F.lit(v) for v in values]), column)
    return F.nullif(place.cast("int"), F.lit(0))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def decimals_to_double(df: DataFrame) -> DataFrame:
    casts = {
        f.name: F.col(f.name).cast("double")
        for f in df.schema
        if isinstance(f.dataType, T.DecimalType)
    }
    return df.withColumns(casts) if casts else df


def booleans_to_int(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("int") for n in names if n in df.columns})


def null_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row: how many NULLs each column holds."""
    return df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
