"""Quality classifier from weak labels.

Heuristic labellers look at a text from different sides and call it good, bad, or abstain. None
is right always, and nobody has labelled the texts; but where labellers overlap, how they agree
tells how accurate each is. Expectation-maximisation estimates, over all documents, the share of
good ones and for each labeller how often it calls good, bad or abstains on good and on bad texts.
The posterior of a document given its votes is then the label from which a linear scorer over
hashed features learns (by a bounded sample), and the scorer judges every document, also where
labellers abstain or contradict each other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from excursio.llm import textbytes, workers

#: Votes; a document's votes are one character for each labeller.
GOOD, BAD, ABSTAIN = 1, 0, 2

_SMALL, _LARGE, _DIGIT, _SPACE, _PLAIN, _MARK, _HIGH = range(7)
_CLASS = np.full(256, _HIGH, np.uint8)
for _b in range(128):
    _c = chr(_b)
    _CLASS[_b] = (
        _SMALL if _c.islower() else _LARGE if _c.isupper() else _DIGIT if _c.isdigit() else _SPACE if _c.isspace()
        else _PLAIN if _c in ".,;:!?'\"()-" else _MARK
    )

#: For each labeller a measure, and where bad begins and good ends (bad is above).
LABELLERS = (
    ("mark_share", 0.04, 0.01),
    ("marked_words", 0.25, 0.05),
    ("capital_share", 0.35, 0.12),
    ("shouted_words", 0.30, 0.05),
    ("repeated_words", 0.15, 0.03),
    ("repeated_pairs", 0.30, 0.05),
    ("repeated_lines", 0.40, 0.10),
    ("lone_marks", 0.15, 0.03),
    ("exclamations", 0.20, 0.05),
    ("word_length", 14.0, 10.0),
    ("few_kinds", 0.35, 0.22),
)


def measures(texts: list) -> np.ndarray:
    """One row per text, one column per labeller; NaN where a text is too short for a measure."""
    raw, starts = textbytes.joined(texts)
    n = len(texts)
    out = np.full((n, len(LABELLERS)), np.nan)
    if not len(raw):
        return out
    kind = _CLASS[raw]
    begins, ends, owner = textbytes.word_spans(raw, starts)
    words = textbytes.word_hashes(raw, begins, ends)
    firsts = np.searchsorted(owner, np.arange(n + 1))
    count = np.diff(firsts).astype(np.float64)

    def cumulated(mask):
        return np.concatenate([[0], np.cumsum(mask)])

    marks, larges, smalls = (cumulated(kind == k) for k in (_MARK, _LARGE, _SMALL))
    solid = cumulated(kind != _SPACE)
    per_text = lambda c: (c[starts[1:]] - c[starts[:-1]]).astype(np.float64)
    per_word = lambda c: c[ends] - c[begins]
    share = lambda mask: np.bincount(owner, mask, n) / np.maximum(count, 1)
    marked, capitals, length = per_word(marks), per_word(larges), ends - begins
    same = np.zeros(len(words))
    same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    twice = np.zeros(len(words))
    twice[2:] = (words[2:] == words[:-2]) & (owner[2:] == owner[:-2])
    out[:, 0] = per_text(marks) / np.maximum(per_text(solid), 1)
    out[:, 1] = share((marked > 0) & (length > 1))
    letters = per_text(larges) + per_text(smalls)
    out[:, 2] = np.where(letters >= 20, per_text(larges) / np.maximum(letters, 1), np.nan)
    out[:, 3] = share((capitals > 1) & (per_word(smalls) == 0))
    out[:, 4] = share(same)
    out[:, 5] = share(twice)
    out[:, 6] = _repeated_lines(raw, starts, n)
    out[:, 7] = share((marked == length) & (length <= 2))
    calls = cumulated(raw == ord("!"))
    out[:, 8] = share(per_word(calls) > 1)
    out[:, 9] = share(length)
    for k in range(n):
        if count[k] >= 50:
            # Kinds of words grow as a power of the words; so this doesn't depend on length.
            out[k, 10] = 1 - np.log(len(np.unique(words[firsts[k] : firsts[k + 1]]))) / np.log(count[k])
    out[count < 8] = np.nan
    return out


def _repeated_lines(raw: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """The share of a text's bytes in lines that it has already had; NaN below four lines."""
    out = np.full(n, np.nan)
    breaks = np.flatnonzero(raw == 10)
    edges = np.union1d(starts[:-1], breaks + 1)
    edges = edges[edges < len(raw)]
    if not len(edges):
        return out
    ends = np.append(edges[1:], len(raw))
    owner = np.searchsorted(starts, edges, "right") - 1
    lines = textbytes.word_hashes(raw, edges, ends)
    firsts = np.searchsorted(owner, np.arange(n + 1))
    for k in np.flatnonzero(np.diff(firsts) >= 4):
        own, size = lines[firsts[k] : firsts[k + 1]], (ends - edges)[firsts[k] : firsts[k + 1]]
        _, first = np.unique(own, return_index=True)
        out[k] = 1 - size[first].sum() / size.sum()
    return out


def votes(measured: np.ndarray) -> np.ndarray:
    bad = np.array([x[1] for x in LABELLERS])
    good = np.array([x[2] for x in LABELLERS])
    out = np.full(measured.shape, ABSTAIN, np.int8)
    with np.errstate(invalid="ignore"):
        out[measured > bad] = BAD
        out[measured <= good] = GOOD
    return out


@dataclass
class LabelModel:
    """Share of good texts, and ``rates[class, labeller, vote]`` of the votes that are cast.

    A labeller abstains because a text is too short for it or lies between its bounds; that by
    itself says nothing about the class.
    """

    good: float
    rates: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The chance that a text with these votes (one row each) is good."""
        logs = np.concatenate([np.log(self.rates), np.zeros((*self.rates.shape[:2], 1))], 2)
        each = np.arange(patterns.shape[1])
        scores = np.stack([logs[c][each, patterns].sum(1) for c in (BAD, GOOD)], 1)
        scores += np.log([1 - self.good, self.good])
        return 1 / (1 + np.exp(np.clip(scores[:, BAD] - scores[:, GOOD], -500, 500)))


#: What is believed of a labeller before any text is seen: it calls one bad text in three bad, and one
#: good text in fifty. The belief weighs as much as this share of the texts.
BELIEF = np.array([[0.33, 0.67], [0.02, 0.98]])
BELIEF_SHARE = 0.05


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> LabelModel:
    """Accuracies of labellers from how often each pattern of votes occurs.

    Starts from ``BELIEF``, specialists that each see some kinds of bad texts; it also says which
    of the two classes is the good one, and stays in the estimates as a prior, without which a kind of
    junk that few labellers see could settle among the good texts.
    """
    m = patterns.shape[1]
    start = np.tile(BELIEF[:, None, :], (1, m, 1))
    prior = start * (1 + BELIEF_SHARE * counts.sum())
    model = LabelModel(0.8, start)
    onehot = (patterns[:, :, None] == np.arange(2)).astype(np.float64)
    for _ in range(rounds):
        good = model.posterior(patterns)
        weights = np.stack([(1 - good) * counts, good * counts])
        rates = np.einsum("cp,pmv->cmv", weights, onehot) + prior
        new = LabelModel(
            float(np.clip((weights[GOOD].sum() + 1) / (counts.sum() + 2), 1e-4, 1 - 1e-4)),
            rates / rates.sum(2, keepdims=True),
        )
        moved = abs(new.good - model.good) + np.abs(new.rates - model.rates).max()
        model = new
        if moved < 1e-9:
            break
    return model


#: Below this score a document is rejected; in doubt it is kept.
LEAST = 0.3

BUCKETS = 1 << 11


def features(texts: list) -> np.ndarray:
    """Hashed features: shapes of words and of pairs of words, and runs of three bytes.

    The shares of ``BUCKETS`` buckets of each kind, as square roots. A text without words has none.
    """
    raw, starts = textbytes.joined(texts)
    n = len(texts)
    out = np.zeros((n, 2 * BUCKETS), np.float32)
    if not len(raw):
        return out
    kind = _CLASS[raw]
    begins, ends, owner = textbytes.word_spans(raw, starts)
    words = textbytes.word_hashes(raw, begins, ends)

    def has(k):
        c = np.concatenate([[0], np.cumsum(kind == k)])
        return c[ends] - c[begins]

    length = ends - begins
    capitals, marks = has(_LARGE), has(_MARK)
    same = np.zeros(len(words), np.int64)
    same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    shape = np.minimum(capitals, 2) + 3 * np.minimum(marks, 2) + 9 * (has(_SMALL) > 0) + 18 * (has(_DIGIT) > 0) + 36 * (has(_PLAIN) > 0)
    shape = shape + 72 * np.minimum(length // 3, 7) + 576 * same
    before = np.full(len(words), 9999, np.int64)
    before[1:] = np.where(owner[1:] == owner[:-1], shape[:-1], 9999)
    for code in (shape, shape * 10007 + before):
        bucket = (textbytes.mixed(code.astype(np.uint64), 31) % np.uint64(BUCKETS)).astype(np.int64)
        out[:, :BUCKETS] += np.bincount(owner * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
    if len(raw) > 2:
        code = raw[:-2].astype(np.uint64) << np.uint64(16) | raw[1:-1].astype(np.uint64) << np.uint64(8) | raw[2:]
        text = np.searchsorted(starts, np.arange(len(code)), "right") - 1
        inside = np.arange(len(code)) + 2 < starts[text + 1]
        bucket = (textbytes.mixed(code[inside], 32) % np.uint64(BUCKETS)).astype(np.int64)
        out[:, BUCKETS:] = np.bincount(text[inside] * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
    for half in (slice(0, BUCKETS), slice(BUCKETS, None)):
        out[:, half] = np.sqrt(out[:, half] / np.maximum(out[:, half].sum(1, keepdims=True), 1))
    return out


def fit_scorer(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 1e-4, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by accelerated gradient steps."""
    x, target = x.astype(np.float32, copy=False), target.astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    ahead, ahead_b = w.copy(), b
    weight = (weight / max(weight.sum(), 1e-9)).astype(np.float32)
    step = 1 / (0.25 * 3.0 + ridge)  # rows have a norm of at most two, and there is an intercept
    for k in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead + ahead_b, -80, 80)))
        slope = weight * (p - target)
        new, new_b = ahead - np.float32(step) * (slope @ x + np.float32(ridge) * ahead), ahead_b - step * float(slope.sum())
        pace = np.float32(k / (k + 3))
        ahead, ahead_b = new + pace * (new - w), new_b + float(pace) * (new_b - b)
        w, b = new, new_b
    return w.astype(np.float64), float(b)


@dataclass
class QualityModel:
    """``weights`` is None where there was nothing to fit; then the labellers' posterior is the score."""

    labels: LabelModel
    weights: np.ndarray | None
    intercept: float

    def scores(self, texts: list, posterior: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return posterior
        return 1 / (1 + np.exp(-np.clip(features(texts) @ self.weights + self.intercept, -500, 500)))


def _voted(docs: DataFrame) -> DataFrame:
    @F.pandas_udf("string")
    def vote(text: pd.Series) -> pd.Series:
        texts = text.tolist()
        rows = [votes(measures(texts[part])) for part in textbytes.slices(texts)]
        return pd.Series(["".join(map(str, row)) for block in rows for row in block], dtype=object)

    return docs.withColumn("votes", vote("text"))


def learn(docs: DataFrame, sample_rows: int = 4000) -> QualityModel:
    """Fit the labellers over all documents, and the scorer on about ``sample_rows`` distinct texts.

    Only counts of vote patterns (at most ``3 ** labellers``) and the sample's hashed features come to the
    driver. The sample is drawn by a hash of the text at a rate of the distinct texts, so copies neither weigh
    more in it nor make it smaller; with fewer distinct texts than ``sample_rows`` all are in it.
    """
    workers.ready(docs.sparkSession)
    voted = _voted(docs.select("text"))
    rows = voted.groupBy("votes").count().collect()
    if not rows:
        flat = np.full((2, len(LABELLERS), 2), 0.5)
        return QualityModel(LabelModel(0.5, flat), None, 0.0)
    patterns = np.array([[int(v) for v in r["votes"]] for r in rows])
    counts = np.array([r["count"] for r in rows], np.float64)
    labels = expectation_maximisation(patterns, counts)

    distinct = docs.agg(F.count_distinct(F.xxhash64("text", F.lit(17)))).first()[0]
    share = min(1.0, sample_rows / distinct)
    draw = F.xxhash64("text", F.lit(17)).bitwiseAND(2**40 - 1) / float(2**40)
    sample = docs.select("text").where(draw < share)

    def example(batches):
        for batch in batches:
            texts = batch["text"].tolist()
            for part in textbytes.slices(texts):
                x = features(texts[part])
                for row, vote in zip(x, votes(measures(texts[part]))):
                    used = np.flatnonzero(row)
                    yield pd.DataFrame({"votes": ["".join(map(str, vote))], "at": [used], "value": [row[used].astype(np.float64)]})

    # A text that is drawn is drawn with all its copies; one of each teaches.
    found = sample.distinct().mapInPandas(example, "votes string, at array<int>, value array<double>").toPandas()
    x = np.zeros((len(found), 2 * BUCKETS), np.float32)
    for k, (at, value) in enumerate(zip(found["at"], found["value"])):
        x[k, at] = value
    if not len(found):
        return QualityModel(labels, None, 0.0)
    target = labels.posterior(np.array([[int(v) for v in vote] for vote in found["votes"]]))
    weights, intercept = fit_scorer(x, target, np.ones(len(x)))
    return QualityModel(labels, weights, intercept)


_RESULT = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("posterior", T.DoubleType()),
        T.StructField("votes", T.StringType()),
    ]
)


def judge(docs: DataFrame, model: QualityModel, into: str = "quality") -> DataFrame:
    """Add a struct ``into``: the scorer's ``score`` (0 to 1), the labellers' ``posterior`` and ``votes``.

    ``votes`` has a character for each labeller: 1 good, 0 bad, 2 no vote. Null and empty texts, and texts of
    fewer than eight words, get no votes; they are scored all the same. Repeated rows are scored alike; other
    columns are passed on, one named ``into`` is replaced.
    """
    workers.ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(_RESULT)
    def scored(text: pd.Series) -> pd.DataFrame:
        frozen, texts, out = shared.value, text.tolist(), []
        for part in textbytes.slices(texts):
            # Features of at most some hundred texts at once: a row has as many columns as buckets.
            own = texts[part]
            for at in range(0, len(own), 500):
                some = own[at : at + 500]
                cast = votes(measures(some))
                posterior = frozen.labels.posterior(cast.astype(np.int64))
                out.append(
                    pd.DataFrame(
                        {
                            "score": frozen.scores(some, posterior),
                            "posterior": posterior,
                            "votes": ["".join(map(str, row)) for row in cast],
                        }
                    )
                )
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=_RESULT.names)

    return docs.withColumn(into, scored("text"))


def accepted(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """Documents that the scorer doesn't take for bad; the columns of ``docs``."""
    judged = judge(docs, learn(docs), "_quality")
    return judged.where(F.col("_quality.score") >= least).select(*docs.columns)
