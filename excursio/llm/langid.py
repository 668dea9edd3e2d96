"""Language identification by partial matching.

Each language gets a context tree over bytes: how often each symbol followed each context of up
to three bytes. With these statistics frozen, a text's code length under a language is the sum
over its symbols of ``-log2 p``: the longest known context predicts the symbol with ``c/(n+q)``,
or, if the symbol never followed it, pays the escape ``q/(n+q)`` and asks the next shorter
context (n: occurrences, q: distinct followers; no exclusions); below the empty context all
symbols are alike. The language with the shortest code wins.

A frozen tree is a sorted array of the runs seen at each depth with their prices, and one of the
contexts seen with the prices of their escapes; what was never seen takes no room, so the order is
the same for any alphabet and any number of languages. A symbol's price depends on it and the
``order`` symbols before it only: each batch walks its distinct runs down the trees once.

Symbols: the bytes of the lower-cased text; every ASCII byte that is no letter counts as a space;
bytes never seen in training share one symbol.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from excursio.llm import textbytes, workers

#: Prices are kept in these parts of a bit.
PARTS = 1024
UNDETERMINED = "und"
#: The sampling rates of at most so many languages are broadcast; above, they are joined by a shuffle.
BROADCAST = 200_000

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32


@dataclass
class LanguageModel:
    """Frozen statistics. ``grams``: runs of ``order + 1`` symbols; ``counts`` by language."""

    languages: list[str]
    order: int
    symbols: np.ndarray
    grams: np.ndarray
    owners: np.ndarray
    counts: np.ndarray

    @property
    def width(self) -> int:
        return len(self.symbols) + 1


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 1 by 3."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _padded(texts: list, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of the texts, each after ``order`` spaces, and where each text starts."""
    lead = " " * order
    raw, starts = textbytes.joined([lead + (t.lower() if isinstance(t, str) else "") for t in texts])
    return _FOLD[raw], starts


def _count_grams(order: int):
    def count(batches):
        for batch in batches:
            for owner, rows in batch.groupby("owner"):
                texts = rows["text"].tolist()
                for part in textbytes.slices(texts):
                    raw, starts = _padded(texts[part], order)
                    gram = np.zeros(max(len(raw) - order, 0), np.int64)
                    for k in range(order + 1):
                        gram = (gram << 8) | raw[k : k + len(gram)]
                    # Positions whose context would reach into the text before are left out.
                    own = np.ones(len(gram), bool)
                    for start in starts[1:-1]:
                        own[max(start - order, 0) : start] = False
                    found, n = np.unique(gram[own], return_counts=True)
                    yield pd.DataFrame({"owner": owner, "gram": found, "n": n})

    return count


def learn(docs: DataFrame, *, rows_per_language: int = 1500, max_order: int = 3) -> LanguageModel:
    """Learn from ``lang``, ``text`` and ``doc_id`` of the documents that aren't held out.

    Every language that any of them has is learned, with contexts of up to ``max_order`` bytes (at
    most 7). The model is fitted on a bounded sample: about ``rows_per_language`` whole documents of
    each language, drawn by a hash of id and text, so repeated rows are drawn together. Rows with a
    null language or text teach nothing; an empty table gives a model without languages.
    """
    if not 0 <= max_order <= 7:
        raise ValueError("max_order must be between 0 and 7")
    spark = docs.sparkSession
    workers.ready(spark)
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    rows = known.groupBy("lang").count().collect()
    languages = sorted(r["lang"] for r in rows)
    if not languages:
        empty = np.zeros(0, np.int64)
        return LanguageModel([], max_order, empty, empty, empty, empty)
    place = {lang: k for k, lang in enumerate(languages)}
    rates = spark.createDataFrame(
        [(r["lang"], place[r["lang"]], rows_per_language / r["count"]) for r in rows], "lang string, owner int, rate double"
    )
    if len(rows) <= BROADCAST:
        rates = F.broadcast(rates)
    draw = (F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), "text").bitwiseAND(2**40 - 1)) / float(2**40)
    sample = known.join(rates, "lang").where(draw < F.col("rate")).select("owner", "text")
    grams = (
        sample.mapInPandas(_count_grams(max_order), "owner int, gram long, n long")
        .groupBy("owner", "gram")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    owners, codes, counts = (grams[c].to_numpy(np.int64) for c in ("owner", "gram", "n"))
    return LanguageModel(languages, max_order, np.union1d(codes & 255, [32]), codes, owners, counts)


@dataclass
class Trees:
    """What workers need of a model. ``levels``: for each language and depth the sorted runs and
    their prices, and the sorted contexts and the prices of their escapes, in parts of a bit."""

    languages: list[str]
    order: int
    base: int
    levels: list[list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]


def _parts(bits: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(bits * PARTS), 65535).astype(np.uint16)


def trees(model: LanguageModel) -> Trees:
    """The frozen context trees of all languages."""
    kind = np.uint32 if model.order <= 3 else np.uint64
    levels = []
    for k in range(len(model.languages)):
        own = model.owners == k
        grams, counts = model.grams[own].view(np.uint64), model.counts[own]
        depths = []
        for d in range(model.order + 1):
            runs, where = np.unique(grams & np.uint64(2 ** (8 * (d + 1)) - 1), return_inverse=True)
            seen = np.bincount(where, counts, len(runs))
            contexts, context = np.unique(runs >> np.uint64(8), return_inverse=True)
            total, distinct = np.bincount(context, seen, len(contexts)), np.bincount(context, minlength=len(contexts))
            paid = _parts(-np.log2(seen / (total + distinct)[context]))
            depths.append((runs.astype(kind), paid, contexts.astype(kind), _parts(-np.log2(distinct / (total + distinct)))))
        levels.append(depths)
    return Trees(model.languages, model.order, round(np.log2(model.width) * PARTS), levels)


def _found(array: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value is, or would be, in a sorted array, and whether it is there."""
    if not len(array):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(array, values), len(array) - 1)
    return at, array[at] == values


def _prices(frozen: Trees, language: int, runs: np.ndarray) -> np.ndarray:
    """Price of the last symbol of each run of ``order + 1`` after the others."""
    price = np.zeros(len(runs), np.int64)
    left = np.arange(len(runs))
    for d in range(frozen.order, -1, -1):
        known, paid, contexts, escapes = frozen.levels[language][d]
        own = runs[left] & runs.dtype.type(2 ** (8 * (d + 1)) - 1)
        at, there = _found(known, own)
        price[left[there]] += paid[at[there]]
        left, own = left[~there], own[~there]
        at, there = _found(contexts, own >> runs.dtype.type(8))
        price[left[there]] += escapes[at[there]]
    price[left] += frozen.base
    return price


def tree_lengths(frozen: Trees, texts: list) -> np.ndarray:
    """Code length of each text in each language, in parts of a bit; one row per text."""
    order = frozen.order
    kind = np.uint32 if order <= 3 else np.uint64
    out = np.zeros((len(texts), len(frozen.languages)), np.int64)
    for part in textbytes.slices(texts, 1 << 19):
        raw, starts = _padded(texts[part], order)
        size, total = len(raw) - order, np.zeros((len(starts) - 1, len(frozen.languages)), np.int64)
        for at in range(0, size, 1 << 19):
            some = min(1 << 19, size - at)
            run = np.zeros(some, kind)
            for k in range(order + 1):
                run = (run << kind(8)) | raw[at + k : at + k + some]
            # A text's own positions begin after its lead; the leads of the later ones are skipped.
            first = np.minimum(np.maximum(starts[:-1] - at, 0), some)
            last = np.minimum(np.maximum(starts[1:] - at - order, 0), some)
            full = first < last
            if not full.any():
                continue
            edges = np.empty(2 * full.sum(), np.int64)
            edges[0::2], edges[1::2] = first[full], last[full]
            runs, where = np.unique(run, return_inverse=True)
            where = np.append(where, len(runs))
            for k in range(len(frozen.languages)):
                cost = np.append(_prices(frozen, k, runs), 0)[where]
                total[full, k] += np.add.reduceat(cost, edges)[0::2]
        out[part] = total
    return out


def code_lengths(model: LanguageModel, texts: list) -> np.ndarray:
    """As ``tree_lengths``, of a model that isn't frozen yet."""
    return tree_lengths(trees(model), texts)


_RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("bits_per_byte", T.DoubleType()),
    ]
)


def identify(docs: DataFrame, model: LanguageModel, into: str = "language") -> DataFrame:
    """Add a struct ``into``: ``lang_pred``, ``score`` and ``bits_per_byte`` of the whole ``text``.

    ``score`` is the posterior of the predicted language if all are equally likely beforehand;
    ``bits_per_byte`` is its code length by the text's bytes. A text that is null or has no
    letter, and every text if no language was learned, is ``und`` with score 0 and null bits.
    Equal code lengths go to the language that sorts first. Very long texts are read whole, in pieces. Other columns are passed on; one
    named ``into`` is replaced. Repeated rows each get their own result.
    """
    undetermined = F.struct(
        F.lit(UNDETERMINED).alias("lang_pred"),
        F.lit(0.0).alias("score"),
        F.lit(None).cast("double").alias("bits_per_byte"),
    )
    if not model.languages:
        return docs.withColumn(into, undetermined)
    workers.ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trees(model))

    @F.pandas_udf(_RESULT)
    def predict(text: pd.Series) -> pd.DataFrame:
        frozen = shared.value
        texts = text.tolist()
        bits = tree_lengths(frozen, texts) / PARTS
        best = bits.argmin(1)
        least = bits[np.arange(len(bits)), best]
        weights = np.exp2(np.maximum(least[:, None] - bits, -1000))
        size = np.array([max(len(t.encode("utf-8", "replace")), 1) if isinstance(t, str) else 1 for t in texts])
        return pd.DataFrame(
            {
                "lang_pred": np.array(frozen.languages, object)[best],
                "score": 1 / weights.sum(1),
                "bits_per_byte": least / size,
            }
        )

    return docs.withColumn(into, F.when(has_letter(F.col("text")), predict("text")).otherwise(undetermined))


def accepted(docs: DataFrame, *, most_bits: float = 7.0) -> DataFrame:
    """Documents in a learned language: not ``und`` and at most ``most_bits`` bits a byte.

    A text of a learned language takes two to four bits a byte, and up to five or six when it is
    full of marks; text whose letters no tree predicts takes a full byte or more. An undetermined
    ``lang`` is filled with the prediction. Returns the columns of ``docs``.
    """
    found = identify(docs, learn(docs), "_language")
    kept = found.where((F.col("_language.lang_pred") != UNDETERMINED) & (F.col("_language.bits_per_byte") <= most_bits))
    return kept.withColumn("lang", F.coalesce("lang", "_language.lang_pred")).select(*docs.columns)
