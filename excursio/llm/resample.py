"""Importance resampling towards a target text: array-scored weights, then a parallel sort.

Features are hashed into buckets; an array holds what a bucket gains, from its share of the target
against its share of the corpus. A document's weight is the mean gain of its features, and with
Gumbel noise from its id the highest scores are a draw without replacement.

Ranks come from parallel sorting by regular sampling. Runs are sorted where they lie; rows at
regular steps of all runs are sorted and give splitters; the splitters cut every run into
segments, equal segments are exchanged and merged, and the counts before a segment turn places
into ranks. Row counts decide where segments begin, and the last key is a row's place, so neither
hot scores nor repeated rows make a segment large. Segments that lie wholly behind the drawn rows
aren't exchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from excursio.llm import textbytes, workers
from excursio.shared import write_shared

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: Rows of a segment; beyond ``MOST_SEGMENTS`` segments they grow instead.
SEGMENT = 1 << 14
MOST_SEGMENTS = 1 << 12
#: Regular samples to a segment.
SAMPLES = 64
_REMEMBERED = 1 << 18
_CHUNK = 1 << 20

_KEEP = bytes(b if b >= 128 or 48 <= b < 58 or 97 <= b < 123 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


class Hasher(dict):
    """The bucket of a feature; remembers a bounded number of them."""

    def __init__(self, buckets: int = BUCKETS, longest: int = 1):
        super().__init__()
        self._buckets, self._longest = buckets, longest

    def __missing__(self, feature: bytes) -> int:
        bucket = crc32(feature) % self._buckets
        if len(self) < _REMEMBERED:
            self[feature] = bucket
        return bucket

    def features(self, text: str | None) -> Iterator[tuple[int, np.ndarray]]:
        """Parts of a text: the number of words met, and the buckets of the features that end there."""
        raw = (text or "").encode("utf-8", "replace").translate(_KEEP)
        at, before = 0, []
        while at < len(raw):
            end = raw.find(b" ", at + _CHUNK)
            end = len(raw) if end < 0 else end
            words = raw[at:end].split()
            found = [*map(self.__getitem__, words)]
            row = before + words
            for n in range(2, self._longest + 1):
                first = max(len(before) - n + 1, 0)
                runs = zip(*(row[first + k :] for k in range(n)))
                found.extend(self[b" ".join(run)] for run in runs)
            before = row[len(row) - self._longest + 1 :] if self._longest > 1 else []
            yield len(words), np.array(found, np.int64)
            at = end


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = 1) -> np.ndarray:
    """How many features of all rows' ``text`` fall into each bucket; repeats count."""
    workers.ready(texts.sparkSession)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, sums = Hasher(buckets, longest), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch["text"]:
                for _, found in hasher.features(text if isinstance(text, str) else None):
                    sums += np.bincount(found, minlength=buckets)
        full = np.flatnonzero(sums)
        yield pd.DataFrame({"bucket": full, "n": sums[full]})

    parts = texts.select("text").mapInPandas(counted, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What each bucket adds to a weight, in thousandths."""
    buckets, total, wanted = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log(((t + 1.0) * (total + buckets)) / ((s + 1.0) * (wanted + buckets))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def weigh(gain: np.ndarray, longest: int = 1):
    """A function of a text column: number of words, of features, and the floored mean of gains."""

    @pandas_udf("n_words long, n_features long, weight long")
    def weighed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(len(gain), longest)
        for batch in batches:
            rows = np.zeros((len(batch), 3), np.int64)
            for row, text in zip(rows, batch):
                for words, found in hasher.features(text if isinstance(text, str) else None):
                    row += (words, len(found), gain[found].sum())
                if row[1]:
                    row[2] //= row[1]
            yield pd.DataFrame(rows, columns=["n_words", "n_features", "weight"])

    return weighed


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, drawn from the id (a null id counts as empty text)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share)))


def scores(docs: DataFrame, gain: np.ndarray, *, longest: int = 1, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` and ``score`` of every row of ``docs``."""
    workers.ready(docs.sparkSession)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), weigh(gain, longest)(F.col("text")).alias("found"))
    flat = found.select("doc_id", "found.*")
    return flat.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


#: The order of the draw, all ascending: score from the highest, null ids last, then what tells rows apart.
_KEYS = ["down", "lacks_id", "id", "weight", "n_features", "at"]


def _sorted_runs(rows: DataFrame) -> DataFrame:
    """Each partition sorted where it lies and written; ``at`` holds its number and the place in it."""
    keyed = rows.select(
        (-F.col("score")).alias("down"),
        F.col("doc_id").isNull().cast("long").alias("lacks_id"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        "weight",
        "n_features",
    )
    runs = keyed.sortWithinPartitions(*_KEYS[:-1]).withColumn("at", F.monotonically_increasing_id())
    return write_shared(runs, "sorted-runs")


def _splitters(runs: DataFrame, rows: int) -> np.ndarray:
    """Keys at which segments begin, from rows at regular steps of all runs.

    At most ``MOST_SEGMENTS * SAMPLES`` keys, and one for each run, come to the driver.
    """
    segments = min(max(math.ceil(rows / SEGMENT), 1), MOST_SEGMENTS)
    step = max(rows // (segments * SAMPLES), 1)
    place = F.col("at").bitwiseAND((1 << 33) - 1)
    some = runs.where(place % step == step // 2).select(*_KEYS).toPandas()
    keys = some.sort_values(_KEYS).to_numpy(np.int64).reshape(-1, len(_KEYS))
    cuts = (np.arange(1, segments) * len(keys)) // segments
    return keys[np.unique(cuts)] if len(keys) else keys


def _segment_of(splitters: np.ndarray):
    """A function of the key columns: how many splitters aren't above a row."""

    @pandas_udf("long")
    def segment(columns: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for series in columns:
            own = np.column_stack([s.to_numpy(np.int64) for s in series])
            both = np.concatenate([splitters, own])
            kind = np.repeat([0, 1], [len(splitters), len(own)])
            order = np.lexsort([kind, *both.T[::-1]])
            passed = np.cumsum(order < len(splitters))
            out = np.empty(len(both), np.int64)
            out[order] = passed
            yield pd.Series(out[len(splitters) :])

    return segment


def ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """Rows of ``scores`` with ``rank`` in descending score, null beyond the first ``drawn``."""
    runs = _sorted_runs(rows)
    splitters = _splitters(runs, runs.count())
    cut = write_shared(runs.withColumn("segment", _segment_of(splitters)(*map(F.col, _KEYS))), "segments")
    counts = {r["segment"]: r["n"] for r in cut.groupBy("segment").agg(F.count("*").alias("n")).collect()}
    before, ahead = {}, 0
    for segment in sorted(counts):
        before[segment], ahead = ahead, ahead + counts[segment]
    reached = [s for s, n in before.items() if n < drawn]
    last = max(reached, default=-1)
    # One number for each segment up to the last that is reached, so at most MOST_SEGMENTS.
    offsets = F.array(*[F.lit(before.get(s, 0)).cast("long") for s in range(last + 1)] or [F.lit(0).cast("long")])
    place = F.row_number().over(Window.partitionBy("segment").orderBy(*_KEYS))
    merged = cut.where(F.col("segment") <= last).withColumn("rank", place + F.get(offsets, F.col("segment").cast("int")))
    behind = cut.where(F.col("segment") > last).withColumn("rank", F.lit(None).cast("long"))
    return merged.unionByName(behind).select(
        F.when(F.col("lacks_id") == 0, F.col("id")).alias("doc_id"),
        "n_features",
        "weight",
        (-F.col("down")).alias("score"),
        F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"),
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Every row's weight and score, and the rank of the ``percent`` of long enough rows drawn.

    ``target`` holds ``text``. Features are all runs of 1 to ``longest`` words. Null and empty texts
    have no features and weight 0; texts of any length are read whole, a part at a time. Repeated rows
    are drawn for themselves. Of equal scores the smaller id comes first and null ids last; rows that
    agree in everything returned are interchangeable. Empty tables give an empty result, or weights
    against an empty target. Further columns aren't read.
    """
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    scored = write_shared(scores(docs, gain, longest=longest, seed=seed), "scores")
    enough = F.col("n_words") >= least_words
    eligible = scored.where(enough)
    short = scored.where(~enough).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return ranked(eligible, percent * eligible.count() // 100).unionByName(short)


#: DuckDB has no crc32: its table and steps are written out for the distinct words.
SQL = r"""
WITH crc_table AS (
    SELECT list_transform(range(256), lambda b: list_reduce(
        [b] || range(8), lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS cells
),
doc_words AS (
    SELECT row_number() OVER () AS row_no, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
),
target_words AS (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM benchmark
),
corpus_counts AS (
    SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM doc_words) GROUP BY word
),
target_counts AS (SELECT word, count(*) AS n FROM target_words GROUP BY word),
vocabulary AS (SELECT word FROM corpus_counts UNION SELECT word FROM target_counts),
hashed AS (
    SELECT word, xor(list_reduce(
        [4294967295::BIGINT] || list_transform(range(1, octet_length(encode(word)) + 1),
            lambda i: ('0x' || substr(hex(encode(word)), (2 * i - 1)::BIGINT, 2))::BIGINT),
        lambda crc, byte: xor(crc >> 8, cells[(xor(crc, byte) & 255) + 1]::BIGINT)), 4294967295) % 10000 AS bucket
    FROM vocabulary, crc_table
),
buckets AS (
    SELECT bucket, coalesce(sum(c.n), 0)::DOUBLE AS s, coalesce(sum(t.n), 0)::DOUBLE AS t
    FROM hashed LEFT JOIN corpus_counts c USING (word) LEFT JOIN target_counts t USING (word) GROUP BY bucket
),
totals AS (
    SELECT coalesce((SELECT sum(n) FROM corpus_counts), 0)::DOUBLE AS s_all,
           coalesce((SELECT sum(n) FROM target_counts), 0)::DOUBLE AS t_all
),
gain AS (
    SELECT bucket, floor(1000 * ln(((t + 1) * (s_all + 10000)) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain
    FROM buckets, totals
),
weighed AS (
    SELECT d.row_no, any_value(d.doc_id) AS doc_id, count(g.gain) AS n_features,
           CASE WHEN count(g.gain) = 0 THEN 0 ELSE floor(sum(g.gain) / count(g.gain))::BIGINT END AS weight
    FROM (SELECT row_no, doc_id, unnest(CASE WHEN len(words) = 0 THEN [NULL] ELSE words END) AS word FROM doc_words) d
    LEFT JOIN hashed h USING (word) LEFT JOIN gain g USING (bucket) GROUP BY d.row_no
),
scored AS (
    SELECT doc_id, n_features, weight,
           weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)
                                         / 4294967296::DOUBLE)))::BIGINT AS score
    FROM weighed
),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, weight, n_features) AS place,
           count(*) FILTER (n_features >= 20) OVER () AS eligible
    FROM scored
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank
FROM ordered
"""
