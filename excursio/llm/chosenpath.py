"""Similarity join on word shingles by chosen paths.

A document is the set of hashes of its runs of five words; two documents are linked if the
Jaccard similarity of their sets is at least the threshold. Documents with equal sets are one
class of copies and go through the join once.

The join repeats independent runs. In a run every set chooses tokens by a hash that all sets
share, on average ``rate / threshold`` of them whatever its size, and goes into the bucket of
each. Two sets with the wanted similarity share at least ``rate`` chosen tokens on average, so
they miss each other in a run with probability ``exp(-rate)`` at most, and in all ``runs`` with
``exp(-rate * runs)`` (6e-6 by default). A set whose other buckets already find every partner of it, up to a chance of
``MISS``, leaves its large buckets. Those that stay large are split again on newly
chosen tokens, as many as bring what the other buckets may miss down to ``MISS``; a path is the sequence of tokens.
Splitting ends when a bucket is small, when most
of it stays together however it is split (then its members are alike), or after the last level.

Large buckets at the end of their path mostly repeat one group of near copies. Their members go to
one centre each, the set of the shingles that most of a group have. If sets differ from their centre
in few enough shingles, they are linked with each other by the triangle inequality: those are counted, not
compared. The rest of a centre's sets is compared once, by what they differ from it in, with all
sets of the centre. Sets well within a centre can't be linked with those that turn out too far from it,
so they leave its buckets.

Buckets are compared by exact intersection, but for pairs of one centre. Large ones are dealt out as
pairs of blocks, so no task holds more than two blocks; none is cut off. A pair that shares
several buckets counts only in that with the smallest path, so pairs are never written out to
be told apart: a task returns, for each set, how many links it found and one member of its
connected part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from excursio.llm import textbytes, workers
from excursio.shared import write_shared

WIDTH = 5
THRESHOLD = 0.8
RUNS = 8
RATE = 1.5
#: Tokens that deeper levels choose at most, as ``RATE`` for the first.
DEEP_RATE = 6.0
LEVELS = 3
#: Buckets of at most so many sets are compared at once.
SMALL = 32
#: Sets in a block of a large bucket.
BLOCK = 512
#: Members of a bucket are alike if so many of the tokens they choose lead at least half of them on.
ALIKE = 0.75
#: Members of a bucket, about, whose tokens decide whether it is alike, and whose shingles make its centre.
JUDGED = 64
#: Sets go to a centre with at least this Jaccard similarity to it.
ATTACHED = 0.4
#: A set may miss a partner with this chance.
MISS = 1e-4
_RUN_MASK = 15


def _chosen(
    sets: list[np.ndarray], rate: float | np.ndarray, level: int, runs: int, threshold: float
) -> list[np.ndarray]:
    """For each set the tokens it chooses in all runs; the lowest bits of a token name the run.

    ``rate`` may differ by set; a token that a set chooses at some rate it also chooses at higher ones.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), sizes)
    limit = np.minimum(rate / threshold / np.maximum(sizes, 1), 1.0)[owner]
    owners, names = [], []
    for run in range(runs):
        draw = textbytes.mixed(tokens, 100 + level * 16 + run)
        taken = (draw >> np.uint64(11)).astype(np.float64) / 2.0**53 < limit
        owners.append(owner[taken])
        name = textbytes.mixed(draw[taken], 99) & np.uint64(2**64 - 1 - _RUN_MASK)
        names.append((name | np.uint64(run)).view(np.int64))
    owners, names = np.concatenate(owners), np.concatenate(names)
    order = np.argsort(owners, kind="stable")
    cuts = np.searchsorted(owners[order], np.arange(1, len(sets)))
    return np.split(names[order], cuts)


def _features(width: int, threshold: float, runs: int, rate: float):
    def features(batches):
        for batch in batches:
            texts, rows = batch["text"].tolist(), batch["row"].to_numpy()
            for part in textbytes.slices(texts):
                sets = textbytes.shingles(texts[part], width)
                yield pd.DataFrame(
                    {
                        "row": rows[part],
                        "sig": [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() for s in sets],
                        "tokens": _chosen(sets, rate, 0, runs, threshold),
                    }
                )

    return features


def _deep_rates(missed: np.ndarray, held: np.ndarray, threshold: float) -> np.ndarray:
    """The rates at which sets have to split their ``held`` large buckets, if all others miss a partner with ``missed``.

    A partner is in a large bucket with a chance of ``threshold`` squared at least, and is met there if
    every level below shares a choice. The partner with the lower rate decides: it reckons for both.
    """
    wanted = (1 - np.minimum(MISS / missed, 1) ** (1 / held)) / threshold**2
    rates = np.linspace(DEEP_RATE / 64, DEEP_RATE, 64)
    met = np.ones(len(rates))
    for _ in range(1, LEVELS):
        met = 1 - np.exp(-rates * met)
    return rates[np.minimum(np.searchsorted(met, wanted), len(rates) - 1)]


def _deep_choices(width: int, threshold: float, runs: int):
    """The tokens of the deeper levels, and those of the highest rate, which judge whether buckets are alike."""

    def choices(batches):
        for batch in batches:
            texts, reps = batch["text"].tolist(), batch["rep"].to_numpy()
            rates = _deep_rates(batch["missed"].to_numpy(), batch["held"].to_numpy(), threshold)
            for part in textbytes.slices(texts):
                sets = textbytes.shingles(texts[part], width)
                out = {"rep": reps[part]}
                for level in range(1, LEVELS):
                    out[f"tokens{level}"] = _chosen(sets, rates[part], level, runs, threshold)
                    out[f"judges{level}"] = _chosen(sets, DEEP_RATE, level, runs, threshold)
                yield pd.DataFrame(out)

    return choices


def _crowded(postings: DataFrame, by: list[str]) -> DataFrame:
    """The postings of buckets with two sets or more, and how many their bucket has (``n``)."""
    counts = postings.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return postings.join(counts, by)


def _missed(chosen: Column, large: Column, threshold: float) -> Column:
    """The chance at most that a set misses a partner in all its buckets but the large ones.

    Of the tokens that a set has chosen, ``large`` lead to large buckets. A partner shares at least
    ``threshold`` of all its tokens, so of the others at least ``(threshold - part) / (1 - part)``, and
    chooses a shared token, too, with a chance of ``threshold`` at least.
    """
    part = large / chosen
    met = F.when(part < threshold, (threshold - part) / (1 - part) * threshold).otherwise(0.0)
    return F.pow(1 - met, chosen - large)


def _children(buckets: DataFrame, deep: DataFrame, tokens: str) -> DataFrame:
    """The buckets of the next level that the members of ``buckets`` choose, a row for each."""
    run = F.col("path").bitwiseAND(_RUN_MASK)
    own = F.filter(tokens, lambda t: t.bitwiseAND(_RUN_MASK) == run)
    found = buckets.join(deep, "rep").select(F.col("path").alias("parent"), "rep", F.explode(own).alias("token"))
    child = F.xxhash64("parent", "token").bitwiseAND(-1 - _RUN_MASK)
    child = child.bitwiseOR(F.col("parent").bitwiseAND(_RUN_MASK))
    return found.select("parent", "rep", child.alias("path"))


def _leaves(sets: DataFrame, texts: DataFrame, options: dict) -> DataFrame:
    """Buckets at the ends of their paths: ``path``, ``rep``, ``n``, ``blocked``."""
    threshold = options["threshold"]
    found = write_shared(_crowded(sets.select("rep", F.explode("tokens").alias("path")), ["path"]), "buckets")
    small = F.col("n") <= SMALL
    leaves = [found.where(small).withColumn("blocked", F.lit(False))]
    held = found.where(~small).groupBy("rep").agg(F.count(F.lit(1)).alias("held"))
    held = held.join(sets.select("rep", F.size("tokens").alias("chosen")), "rep")
    held = held.withColumn("missed", _missed(F.col("chosen"), F.col("held"), threshold)).where(F.col("missed") > MISS)
    held = write_shared(held.select("rep", "held", "missed"), "held")
    large = write_shared(_crowded(found.where(~small).drop("n").join(held.select("rep"), "rep"), ["path"]), "buckets")
    leaves.append(large.where(small).withColumn("blocked", F.lit(False)))
    large = large.where(~small)
    deep = texts.join(held.join(large.select("rep").distinct(), "rep"), "rep").mapInPandas(
        _deep_choices(options["width"], threshold, options["runs"]),
        "rep long" + "".join(f", tokens{k} array<long>, judges{k} array<long>" for k in range(1, LEVELS)),
    )
    deep = write_shared(deep, "choices")
    for level in range(1, LEVELS):
        # Some members settle whether a bucket is alike: that only decides how it is compared.
        draw = F.xxhash64("path", "rep", F.lit(level)).bitwiseAND(2**30 - 1) / float(2**30)
        judged = _children(large.where(draw * F.col("n") < JUDGED), deep, f"judges{level}")
        met = judged.groupBy("parent").agg(F.count_distinct("rep").alias("above"))
        kinds = judged.groupBy("parent", "path").agg(F.count(F.lit(1)).alias("n")).join(met, "parent")
        kept_together = F.sum(F.when(F.col("n") * 2 >= F.col("above"), F.col("n")).otherwise(0))
        alike = kinds.groupBy("parent").agg((kept_together >= F.sum("n") * ALIKE).alias("alike")).where("alike")
        together = write_shared(alike.select(F.col("parent").alias("path")), "alike")
        leaves.append(large.join(together, "path").withColumn("blocked", F.lit(True)))
        children = _children(large.join(together, "path", "left_anti"), deep, f"tokens{level}")
        below = write_shared(_crowded(children.select("path", "rep"), ["path"]), "buckets")
        leaves.append(below.where(small).withColumn("blocked", F.lit(False)))
        large = below.where(~small)
    leaves.append(large.withColumn("blocked", F.lit(True)))
    columns = ["path", "rep", "n", "blocked"]
    out = leaves[0].select(*columns)
    for more in leaves[1:]:
        out = out.unionByName(more.select(*columns))
    return out


def _distinct_buckets(leaves: DataFrame) -> DataFrame:
    """One of each set of buckets that have the same members."""
    member = F.xxhash64("rep")
    members = leaves.groupBy("path", "n", "blocked").agg(
        F.bit_xor(member).alias("x"), F.bit_xor(F.xxhash64(member)).alias("y")
    )
    first = members.groupBy("n", "x", "y").agg(F.min("path").alias("path")).select("path")
    return leaves.join(first, "path")


def _bases(width: int):
    def base(key, rows):
        texts = rows["text"].tolist()
        sets = [s for part in textbytes.slices(texts) for s in textbytes.shingles(texts[part], width)]
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        return pd.DataFrame({"centre": [key[0]], "base": [values[2 * counts > len(sets)].view(np.int64)]})

    return base


def _differences(width: int):
    """How alike sets are to a centre (``alike``), and the shingles that only they or only the centre has, if they go to it."""

    def differences(batches):
        for batch in batches:
            texts, reps, centres = batch["text"].tolist(), batch["rep"].to_numpy(), batch["centre"].to_numpy()
            bases = batch["base"].tolist()
            for part in textbytes.slices(texts):
                rows = []
                sets = textbytes.shingles(texts[part], width)
                for rep, centre, base, own in zip(reps[part], centres[part], bases[part], sets):
                    diff = np.setxor1d(own.view(np.int64), np.asarray(base, np.int64))
                    both = len(own) + len(base)
                    alike = (both - len(diff)) / (both + len(diff))
                    rows.append((rep, centre, alike, len(own), diff if alike >= ATTACHED else diff[:0]))
                yield pd.DataFrame(rows, columns=["rep", "centre", "alike", "size", "diff"])

    return differences


def _tried(leaves: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Members of large buckets with a centre: ``rep``, ``centre`` (never 0), ``alike``, ``size``, ``diff``.

    Buckets that share half of their members use the centre of the largest of them. Where a set goes
    only decides how it is compared.
    """
    held = leaves.where("blocked and path <> 0").select("rep", "path", "n")
    draw = F.xxhash64("path", "rep", F.lit(0)).bitwiseAND(2**30 - 1) / float(2**30)
    sample = write_shared(held.where(draw * F.col("n") < JUDGED).select("path", "rep"), "sample")
    shared = sample.join(held.select("rep", F.struct("n", F.col("path").alias("centre")).alias("to")), "rep")
    shared = shared.groupBy("path", "to").agg(F.count(F.lit(1)).alias("met"))
    drawn = sample.groupBy("path").agg(F.count(F.lit(1)).alias("drawn"))
    centres = shared.join(drawn, "path").where("met * 2 >= drawn").groupBy("path").agg(F.max("to").alias("to"))
    centres = write_shared(centres, "centres")
    judged = sample.join(centres.select(F.col("to.centre").alias("path")).distinct(), "path").join(texts, "rep")
    bases = judged.groupBy("path").applyInPandas(_bases(width), "centre long, base array<long>")
    own = held.join(centres, "path").groupBy("rep").agg(F.max("to").alias("to")).select("rep", "to.centre")
    found = own.join(write_shared(bases, "bases"), "centre").join(texts, "rep")
    found = found.mapInPandas(_differences(width), "rep long, centre long, alike double, size long, diff array<long>")
    return write_shared(found, "tried")


def _seats(members: DataFrame) -> DataFrame:
    """The pairs of blocks (``i``, ``j``) in which members of each ``path`` are compared.

    Those of ``kind`` 0 meet all, those of 1 each other, too; those of 2 don't meet but those of 0.
    """
    kind = F.col("kind")
    blocks = [F.ceil(F.count_if(kind == k) / BLOCK).alias(f"blocks{k}") for k in range(3)]
    seats = members.join(members.groupBy("path").agg(*blocks), "path")
    ends = [F.col("blocks0"), F.col("blocks0") + F.col("blocks1"), F.col("blocks0") + F.col("blocks1") + F.col("blocks2")]
    begin = F.when(kind == 0, 0).when(kind == 1, ends[0]).otherwise(ends[1])
    own = F.when(kind == 0, F.col("blocks0")).when(kind == 1, F.col("blocks1")).otherwise(F.col("blocks2"))
    meets = F.when(kind == 0, ends[2]).when(kind == 1, ends[1]).otherwise(ends[0])
    seats = seats.withColumn("block", begin + F.pmod(F.xxhash64("rep", F.lit(5)), own)).where(meets > 0)
    seats = seats.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), meets - 1)))
    return seats.select("path", "rep", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def _parted(leaves: DataFrame, tried: DataFrame, threshold: float) -> DataFrame:
    """Buckets that hold more than the sets of one centre: ``path``, ``rep``, ``centre`` (or 0), ``kind``.

    In large buckets, sets that have tried the most frequent centre are of kind 1. Jaccard distances
    obey the triangle inequality, so those that it holds well within (kind 2) have no links with those that
    it doesn't hold.
    """
    members = leaves.select("path", "rep", "blocked").join(tried.select("rep", "centre", "alike"), "rep", "left")
    held = F.when(F.col("alike") >= ATTACHED, F.col("centre")).otherwise(0)
    members = members.withColumn("tried", F.col("centre")).withColumn("centre", held)
    parts = members.groupBy("path", "centre").agg(F.count(F.lit(1)).alias("k"))
    most = F.max(F.when(F.col("centre") != 0, F.struct("k", F.col("centre").alias("most")))).alias("top")
    mixed = parts.groupBy("path").agg(most, F.sum("k").alias("n")).where("top is null or top.k < n")
    members = members.join(mixed.select("path", "top.most"), "path")
    inner = F.col("alike") >= ATTACHED + 1 - threshold + 1e-6
    kind = F.when(F.col("blocked") & (F.col("tried") == F.col("most")), F.when(inner, 2).otherwise(1)).otherwise(0)
    return members.select("path", "rep", "centre", kind.alias("kind"))


def _incidence(lists: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the lists share."""
    n = len(lists)
    values = np.concatenate(lists)
    owner = np.repeat(np.arange(n), [len(x) for x in lists])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1 if len(column) else np.zeros(0, bool)
    owner, column = owner[shared], column[shared]
    common = np.zeros((n, n), np.float32)
    if not len(column):
        return common
    column = np.cumsum(np.r_[True, column[1:] != column[:-1]]) - 1
    step = 4096
    for at in range(0, column[-1] + 1, step):
        a, b = np.searchsorted(column, [at, at + step])
        grid = np.zeros((n, min(step, column[-1] + 1 - at)), np.float32)
        grid[owner[a:b], column[a:b] - at] = 1
        common += grid @ grid.T
    return common


def _linked(rows: pd.DataFrame, near: np.ndarray) -> pd.DataFrame | None:
    """The sets that have links by ``near``: a member of their part, and the weight of their links."""
    if not near.any():
        return None
    reps = rows["rep"].to_numpy()
    weights = near @ rows["copies"].to_numpy(np.int64)
    some = np.flatnonzero(near.any(1))
    label = np.arange(len(reps))
    while True:
        least = np.where(near[some], label[None, :], len(reps)).min(1)
        less = np.minimum(label[some], least)
        if (less == label[some]).all():
            break
        label[some] = less
    return pd.DataFrame({"rep": reps[some], "part": reps[label[some]], "links": weights[some]})


def _near(common: np.ndarray, sizes: np.ndarray, threshold: float) -> np.ndarray:
    near = common * (1 + threshold) >= threshold * (sizes[:, None] + sizes[None, :]) - 1e-6
    near &= common > 0
    np.fill_diagonal(near, False)
    return near


def _in_bucket(threshold: float):
    """Links that count in this bucket."""

    def linked(rows, path):
        sets = rows["set"].tolist()
        near = _near(_incidence(sets).astype(np.float64), np.array([len(s) for s in sets], np.float64), threshold)
        centres = rows["centre"].to_numpy()
        near &= (centres[:, None] != centres[None, :]) | (centres == 0)[:, None]
        if near.any():
            leaves = [np.asarray(x, np.int64) for x in rows["leaves"]]
            near &= _incidence([x[x < path] for x in leaves]) == 0
        return near

    return linked


def _at_centre(threshold: float):
    """Links between sets of a centre, by what they differ from it in."""

    def linked(rows, path):
        diffs = [np.asarray(x, np.int64) for x in rows["diff"]]
        apart = np.array([len(x) for x in diffs], np.float64)
        sizes = rows["size"].to_numpy(np.float64)
        common = (sizes[:, None] + sizes[None, :] - apart[:, None] - apart[None, :]) / 2 + _incidence(diffs)
        return _near(common, sizes, threshold)

    return linked


def _compare(linked, width: int):
    """Links of every pair of blocks by ``linked``; rows come by ``path``, ``i`` and ``j``."""

    def compare(batches):
        key, held = None, []

        def settle():
            rows = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
            rows = rows.drop_duplicates("rep")
            if len(rows) < 2:
                return None
            path, i, j = key
            near = linked(rows, path)
            if i != j:
                blocks = rows["block"].to_numpy()
                near &= blocks[:, None] != blocks[None, :]
            return _linked(rows, near)

        for batch in batches:
            if "text" in batch:
                texts = batch.pop("text").tolist()
                batch["set"] = [s for part in textbytes.slices(texts) for s in textbytes.shingles(texts[part], width)]
                del texts
            for own, rows in batch.groupby(["path", "i", "j"], sort=False):
                if own != key:
                    if held and (found := settle()) is not None:
                        yield found
                    key, held = own, []
                held.append(rows)
        if held and (found := settle()) is not None:
            yield found

    return compare


def _links(members: DataFrame, facts: DataFrame, linked, width: int) -> DataFrame:
    """Links within each ``path``, compared in pairs of blocks: ``rep``, ``part``, ``links``."""
    return (
        _seats(members)
        .join(facts, "rep")
        .repartition("path", "i", "j")
        .sortWithinPartitions("path", "i", "j")
        .mapInPandas(_compare(linked, width), "rep long, part long, links long")
    )


def _centre_links(attached: DataFrame, classes: DataFrame, width: int, threshold: float) -> DataFrame:
    """Links between sets of the same centre: ``rep``, ``part``, ``links``."""
    members = attached.join(classes.select("rep", "copies"), "rep").withColumnRenamed("centre", "path")
    main = F.size("diff") * (1 + threshold) <= (1 - threshold) * F.col("size")
    seated = members.select("path", "rep", F.when(main, 2).otherwise(0).alias("kind"))
    far = _links(seated, members.drop("path"), _at_centre(threshold), width)
    # Two main sets differ in (1 - t) / (1 + t) of their sizes' sum at most.
    close = members.where(main).groupBy("path").agg(F.sum("copies").alias("all"), F.min("rep").alias("part"))
    close = members.where(main).join(close, "path").select("rep", "part", (F.col("all") - F.col("copies")).alias("links"))
    return far.unionByName(close.where("links > 0"))


def components(edges: DataFrame) -> DataFrame:
    """The least node of each node's connected part, from edges (``a``, ``b``): ``node``, ``label``.

    In every round a node takes the least label among its neighbours and then the label of the
    node that it is labelled with, until nothing changes. Each round is written and read again.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct()
    both = write_shared(both, "edges")
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label"))
    labels = write_shared(labels, "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        met = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("to")
        )
        ahead = labels.select(F.col("node").alias("to"), F.col("label").alias("ahead"))
        moved = met.join(ahead, "to", "left").select("node", "old", F.least("to", F.coalesce("ahead", "to")).alias("label"))
        moved = write_shared(moved, "labels")
        changed = moved.agg(F.count_if(F.col("old") != F.col("label"))).first()[0]
        labels = moved.select("node", "label")
        if not changed:
            return labels


def near_duplicates(
    docs: DataFrame, *, width: int = WIDTH, threshold: float = THRESHOLD, runs: int = RUNS, rate: float = RATE
) -> DataFrame:
    """Add ``class_id``, ``links``, ``copies`` and ``kept`` to the documents.

    ``class_id`` is the least ``doc_id`` of the documents connected by links (null if all their
    ids are null), ``links`` the number of other documents at or above the threshold,
    ``copies`` the number with the same set of shingles, the row itself included. ``kept`` is true for
    exactly one row of each class, one with ``class_id`` as its id.

    A text of fewer than ``width`` words has one shingle, all its words. Null, empty and
    wordless texts are copies of each other. Repeated rows are copies. An empty table gives an
    empty result. Columns of ``docs`` with these names or named ``row`` are replaced.
    """
    if not 1 <= runs <= _RUN_MASK + 1:
        raise ValueError(f"runs must be between 1 and {_RUN_MASK + 1}")
    workers.ready(docs.sparkSession)
    options = {"width": width, "threshold": threshold, "runs": runs}
    plain = docs.drop("class_id", "links", "copies", "kept", "row")
    rows = write_shared(plain.withColumn("row", F.monotonically_increasing_id()), "documents")
    features = rows.select("row", "text").mapInPandas(
        _features(width, threshold, runs, rate), "row long, sig string, tokens array<long>"
    )
    features = write_shared(features, "shingles")
    classes = features.groupBy("sig").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = write_shared(classes, "classes")
    sets = features.select(F.col("row").alias("rep"), "tokens").join(classes.select("rep"), "rep")
    texts = rows.select(F.col("row").alias("rep"), "text")
    leaves = write_shared(_distinct_buckets(_leaves(sets, texts, options)), "leaves")

    tried = _tried(leaves, texts, width)
    leaves = write_shared(_parted(leaves, tried, threshold), "parted")
    lists = leaves.groupBy("rep").agg(F.collect_list("path").alias("leaves"), F.first("centre").alias("centre"))
    members = texts.join(lists, "rep").join(classes.select("rep", "copies"), "rep")
    compared = _links(leaves.select("path", "rep", "kind"), members, _in_bucket(threshold), width)
    compared = compared.unionByName(_centre_links(tried.where(F.col("alike") >= ATTACHED), classes, width, threshold))
    compared = write_shared(compared, "links")
    links = compared.groupBy("rep").agg(F.sum("links").alias("near"))
    labels = components(compared.select(F.col("rep").alias("a"), F.col("part").alias("b")))

    by_class = classes.join(links, "rep", "left").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    by_class = by_class.select(
        "sig",
        "copies",
        (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("links"),
        F.coalesce("label", "rep").alias("label"),
    )
    placed = write_shared(features.select("row", "sig").join(by_class, "sig").drop("sig"), "placed")
    known = rows.select("row", "doc_id").join(placed.select("row", "label"), "row")
    ids = known.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    kept = (
        known.join(ids, "label")
        .where(F.col("doc_id").eqNullSafe(F.col("class_id")))
        .groupBy("label")
        .agg(F.min("row").alias("first"), F.first("class_id").alias("class_id"))
    )
    marks = placed.join(kept, "label").select(
        "row", "class_id", "links", "copies", (F.col("row") == F.col("first")).alias("kept")
    )
    return rows.join(marks, "row").drop("row")


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """One document of each class of near duplicates; the columns of ``docs``, whatever their names."""
    own = ("doc_id", "text")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    packed = docs.select(*own, F.struct(*others, F.lit(0).alias("_")).alias("others"))
    kept = near_duplicates(packed, **options).where("kept")
    return kept.select(*[F.col(c if c in own else f"others.`{c}`") for c in docs.columns])
