"""Running totals and previous rows inside ordered groups, safe against one huge group.

Rows are range-partitioned on (key, order), which cuts a large group into consecutive chunks on
several tasks. Each chunk is solved on its own and receives what the earlier chunks of the same
key left behind. Ranges are contiguous, so only a chunk's first and last key can reach into
another chunk: the hand-over holds at most two rows per chunk and is safe to broadcast whatever
the data look like. The ranged rows are written once, which fixes their chunks.

Rows with a NULL key belong to no group: totals are 0 and there is no previous row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from excursio.shared import write_shared

_CHUNK = "__chunk"
_CARRY = "__carry"


def running_total(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    value: Column,
    name: str,
    chunks: int | None = None,
) -> DataFrame:
    """Add ``name``: sum of ``value`` over the key's earlier rows (current row excluded)."""
    df = df.withColumn(name, value)
    spread = _spread(df, key, order_by, chunks)
    totals = _edge_rows(spread, key).groupBy(key, _CHUNK).agg(F.sum(name).alias("total"))
    carried = totals.withColumn(
        _CARRY, F.sum("total").over(_earlier(Window.partitionBy(key).orderBy(_CHUNK)))
    ).select(key, _CHUNK, _CARRY)
    joined = spread.join(F.broadcast(carried), [key, _CHUNK], "left")
    local = F.sum(name).over(_earlier(_window(key, order_by)))
    total = F.coalesce(local, F.lit(0)) + F.coalesce(F.col(_CARRY), F.lit(0))
    return joined.withColumn(name, _known(key, total, F.lit(0))).select(*df.columns)


def previous_values(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    columns: dict[str, str],
    chunks: int | None = None,
) -> DataFrame:
    """Add ``new name -> column of the key's previous row`` for each entry of ``columns``."""
    row = F.struct(*[F.col(c).alias(new) for new, c in columns.items()])
    none = F.lit(None)
    spread = _spread(df, key, order_by, chunks)
    last = F.max_by(row, F.struct(*order_by)).alias("last")
    tails = _edge_rows(spread, key).groupBy(key, _CHUNK).agg(last)
    carried = tails.withColumn(
        _CARRY, F.lag("last").over(Window.partitionBy(key).orderBy(_CHUNK))
    ).select(key, _CHUNK, _CARRY)
    joined = spread.join(F.broadcast(carried), [key, _CHUNK], "left")
    local = F.lag(row).over(_window(key, order_by))
    joined = joined.withColumn(_CARRY, _known(key, F.coalesce(local, F.col(_CARRY)), none))
    return joined.select(*df.columns, *[f"{_CARRY}.{new}" for new in columns])


def _spread(df: DataFrame, key: str, order_by: Sequence[str], chunks: int | None) -> DataFrame:
    """Rows tagged with the range they fall in; written once so that the tags stay fixed."""
    chunks = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(chunks, key, *order_by)
    return write_shared(ranged.withColumn(_CHUNK, F.spark_partition_id()), "ordered")


def _edge_rows(spread: DataFrame, key: str) -> DataFrame:
    """Rows of keys that start or end a chunk (at most two keys per chunk)."""
    edges = spread.groupBy(_CHUNK).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    keys = edges.select(F.explode(F.array("low", "high")).alias(key)).distinct()
    return spread.join(F.broadcast(keys), key, "left_semi")


def _window(key: str, order_by: Sequence[str]) -> WindowSpec:
    # NULL keys form no group: scatter them by row content instead of sorting them together.
    scatter = F.when(F.col(key).isNull(), F.xxhash64(*order_by))
    return Window.partitionBy(_CHUNK, key, scatter).orderBy(*order_by)


def _earlier(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _known(key: str, value: Column, otherwise: Column) -> Column:
    return F.when(F.col(key).isNotNull(), value).otherwise(otherwise)
