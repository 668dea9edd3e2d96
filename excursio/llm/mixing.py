"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a budget of words. A budget is spent on whole passes over the source (epochs)
first; what remains is spent on a weighted sample without replacement: each document draws an
exponential key ``-ln(u) / quality``, the documents are taken in ascending order of their keys,
and a running sum of their sizes is cut at the budget.

A hot source isn't sorted in one place: keys are cut into buckets of about ``rows_per_bucket``
documents, sizes are summed per bucket, and the running sum goes on from each bucket's offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from excursio.shared import write_shared

WORD = r"[^\x20\x09-\x0D]+"
#: Letters, digits, white space and common punctuation.
PLAIN = r"""[\p{L}\p{N}\x20\x09-\x0D.,;:!?'"()-]+"""
WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def quality(text: Column) -> Column:
    """From 1 for plain text down to 0.2 for text of marks only; null and empty text: 1."""
    body = F.coalesce(text, F.lit(""))
    marks = F.char_length(F.regexp_replace(body, PLAIN, ""))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(4.0) * marks / F.greatest(F.char_length(body), F.lit(1)))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """Budget of each source from rows of (``source``, ``size``).

    Sources in code-point order, null last, take ``weights`` in turn and share the sum of all
    sizes. A budget ends at ``most_epochs`` times its source's size, and the excess is shared by
    weight among the others until none is above. That is: a budget is ``min(cap, level * weight)``
    with one level for all, found by filling up the sources in order of ``cap / weight``.

    One row per source: ``sid`` (its place, from 0), ``source``, ``source_size``, ``documents``
    and ``target``. Only this table, of one row per source, passes through one task.
    """
    sources = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents")
    )
    every = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.withColumn("sid", place).withColumn("weight", table[F.col("sid") % len(weights)])
    cap = F.col("source_size") * most_epochs
    before = Window.orderBy(cap / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    levels = ranked.withColumn(
        "level",
        (F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    ).withColumn("open", F.col("level") * F.col("weight") <= cap)
    # The first open source has the level of all; filling up sources beyond it only lowers it.
    level = F.max(F.when(F.col("open"), F.col("level"))).over(every)
    return levels.select(
        "sid",
        "source",
        "source_size",
        "documents",
        F.least(cap.cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("weight")).alias("target"),
    )


def unit_draw(doc_id: Column, seed: str) -> Column:
    """A number inside (0, 1) that depends on the id and the seed only."""
    digest = F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def mix(
    docs: DataFrame,
    *,
    weights: tuple[float, ...] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    seed: str = "mix",
    rows_per_bucket: int = 2000,
) -> DataFrame:
    """How many words the mix takes of each document; all rows, one result each.

    Returns ``doc_id``, ``size``, ``source_size``, ``target`` and ``taken``. ``taken`` is ``size``
    times the complete epochs, plus the words by which the document lies within the rest of the
    budget, so each source's taken words are its target, rounded. The document at the cut is
    taken in part.

    Null and wordless texts have size 0 and nothing is taken of them; a null source is a source of
    its own, the last. Documents with equal keys (repeated ids) go by id and size; fully repeated
    rows are interchangeable. An empty table gives an empty result. Other columns aren't read.
    """
    return _taken(docs, (), weights, most_epochs, seed, rows_per_bucket)


def _taken(
    docs: DataFrame, kept: tuple[str, ...], weights: tuple[float, ...], most_epochs: int, seed: str, rows_per_bucket: int
) -> DataFrame:
    """``mix`` with the columns ``kept`` of ``docs``; they also tell rows of equal key, id and size apart."""
    sized = docs.select(
        *kept,
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        (-F.ln(unit_draw(F.col("doc_id"), seed)) / quality(F.col("text"))).alias("key"),
    )
    budgets = targets(docs.select("source", word_count(F.col("text")).alias("size")), weights, most_epochs)
    joined = sized.join(budgets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    buckets = F.ceil(F.col("documents") / rows_per_bucket)
    placed = joined.withColumn("bucket", F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * buckets))
    own = Window.partitionBy("sid", "bucket").orderBy("key", "doc_id", "size", *kept)
    rows = placed.withColumn("before", F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    sums = placed.groupBy("sid", "bucket").agg(F.sum("size").alias("bucket_size"))
    along = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("sid", "bucket", F.coalesce(F.sum("bucket_size").over(along), F.lit(0)).alias("offset"))
    budget = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - F.col("passes") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("offset") - F.col("before")))
    return (
        rows.join(offsets, ["sid", "bucket"])
        .withColumn("passes", passes)
        .select(
            *kept,
            "doc_id",
            "size",
            "source_size",
            "target",
            (F.col("passes") * F.col("size") + part).cast("long").alias("taken"),
        )
    )


def mixed_documents(
    docs: DataFrame,
    *,
    weights: tuple[float, ...] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    seed: str = "mix",
    rows_per_bucket: int = 2000,
) -> DataFrame:
    """The mix as rows: each document as often as its epochs say, with the columns of ``docs``.

    Texts stay whole: a document is repeated ``taken / size`` times, rounded, so that the one at
    the cut is in if at least half of it lies within the budget. Documents without words are left
    out. Every row counts by itself, also one with a null id or with an id that others have: rows
    are told apart by a number that is written with them.
    """
    numbered = write_shared(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    found = _taken(numbered, ("_row",), weights, most_epochs, seed, rows_per_bucket).where(F.col("size") > 0)
    copies = found.select("_row", F.round(F.col("taken") / F.col("size")).cast("int").alias("_copies"))
    copies = copies.where(F.col("_copies") > 0)
    again = F.explode(F.array_repeat(F.lit(0), F.col("_copies")))
    return numbered.join(copies, "_row").withColumn("_again", again).select(*docs.columns)


SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         -ln((CAST('0x' || substr(md5('mix/' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
             / 4503599627370496.0::DOUBLE)
           / (1.0::DOUBLE / (1.0::DOUBLE + 4.0::DOUBLE
              * length(regexp_replace(coalesce(text, ''), '{PLAIN.replace("'", "''")}', '', 'g'))
              / greatest(length(coalesce(text, '')), 1))) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, CASE sid % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM sources),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0.0::DOUBLE)) AS level
  FROM ranked
  WINDOW before AS (ORDER BY 3 * source_size / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
budgets AS (
  SELECT *, least(CAST(3 * source_size AS DOUBLE),
                  coalesce(max(CASE WHEN level * weight <= 3 * source_size THEN level END) OVER (), 0.0) * weight) AS target
  FROM levels),
running AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, CAST(round(b.target) AS BIGINT) AS budget,
         sum(s.size) OVER (PARTITION BY b.sid ORDER BY s.key, s.doc_id, s.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS before
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size > 0 THEN
         budget // source_size * size + greatest(0, least(size, budget % source_size - before)) ELSE 0 END AS BIGINT) AS taken
FROM running
"""
