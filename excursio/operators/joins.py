"""Reference checks and splits between a child table and its parent.

None of these broadcast by hint: parents may grow with the data, so the planner's own size
check (and adaptive re-planning) decides, with a sort-merge join beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from excursio.shared import write_shared


def missing_parents(
    child: DataFrame, columns: Sequence[str], parent: DataFrame, fields: Sequence[str]
) -> DataFrame:
    """Child key values with no parent and how many child rows carry them (``n_rows``).

    NULL keys pass. Keys are counted before the join, so a hot key is one row in it.
    """
    keys = [f"k{i}" for i in range(len(columns))]
    renamed = child.select(*[F.col(c).alias(k) for c, k in zip(columns, keys)]).dropna()
    counted = renamed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(*[F.col(f).alias(k) for f, k in zip(fields, keys)])
    unmatched = counted.join(known, keys, "left_anti")
    return unmatched.select(*[F.col(k).alias(c) for c, k in zip(columns, keys)], "n_rows")


def split_by_parent(
    child: DataFrame, parent: DataFrame, column: str, reason: str
) -> tuple[DataFrame, DataFrame]:
    """(rows whose key exists in ``parent``, the others tagged with ``quarantine_reason``)."""
    known = parent.select(column).distinct()
    kept = child.join(known, column, "left_semi").select(*child.columns)
    rejected = child.join(known, column, "left_anti").select(*child.columns)
    return kept, rejected.withColumn("quarantine_reason", F.lit(reason))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name, paired up so that planning time stays linear in the number of parts."""
    frames = list(parts)
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return frames[0]


def unmatched_between(
    left: DataFrame, right: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows of each side whose keys the other side lacks."""
    return left.join(right, list(keys), "left_anti"), right.join(left, list(keys), "left_anti")


def matched_once(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: str,
    right_id: str,
    left_time: str,
    right_time: str,
    within_minutes: int,
) -> DataFrame:
    """Pairs (``left_id``, ``right_id``, ``minutes_apart``) of equal keys and near times, each row in one pair at most.

    The nearest pairs go first, ties to the smaller left and then right id; what they use is gone for
    others. Candidates meet on keys and time bins as wide as the limit, so a row is compared with
    its neighbourhood only, and a key with many rows is spread over its bins. Rows with a null key,
    id or time are in no pair. Pairs that are nearest for both sides are taken side by side, round by
    round, which gives the same pairs as one by one.
    """
    width = within_minutes * 60_000_000

    def micros(column: str) -> Column:
        return F.unix_micros(F.col(column).cast("timestamp"))

    a = left.select(*keys, F.col(left_id).alias("left_id"), micros(left_time).alias("left_at"))
    a = a.withColumn("bin", F.floor(F.col("left_at") / width))
    a = a.withColumn("bin", F.explode(F.sequence(F.col("bin") - 1, F.col("bin") + 1)))
    b = right.select(*keys, F.col(right_id).alias("right_id"), micros(right_time).alias("right_at"))
    b = b.withColumn("bin", F.floor(F.col("right_at") / width))
    apart = F.abs(F.col("left_at") - F.col("right_at"))
    met = a.join(b, [*keys, "bin"]).select("left_id", "right_id", apart.alias("apart"))
    open_pairs = write_shared(met.filter(F.col("apart") <= width).dropna(), "candidates")
    rounds: list[DataFrame] = []
    while not open_pairs.isEmpty():
        of_left = open_pairs.groupBy("left_id").agg(F.min(F.struct("apart", "right_id")).alias("to"))
        # From the right the left id breaks ties first, as in the order of all pairs.
        of_right = open_pairs.groupBy("right_id").agg(F.min(F.struct("apart", "left_id")).alias("back"))
        nearest = of_left.select("left_id", F.col("to.right_id").alias("right_id"), F.col("to.apart").alias("apart"))
        mutual = nearest.join(of_right, "right_id").filter(F.col("back.left_id") == F.col("left_id"))
        taken = write_shared(mutual.select("left_id", "right_id", "apart"), "pairs")
        rounds.append(taken)
        left_over = open_pairs.join(taken.select("left_id"), "left_id", "left_anti")
        left_over = left_over.join(taken.select("right_id"), "right_id", "left_anti")
        open_pairs = write_shared(left_over.select("left_id", "right_id", "apart"), "candidates")
    pairs = rounds[0] if rounds else open_pairs
    for more in rounds[1:]:
        pairs = pairs.unionByName(more)
    minutes = (F.col("apart") / 60_000_000).alias("minutes_apart")
    return pairs.select(F.col("left_id").alias(left_id), F.col("right_id").alias(right_id), minutes)
