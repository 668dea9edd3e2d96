"""The prefix trie of conversations, with subtree totals by parallel tree contraction.

A node is a sequence of first turns. Turns are numbered in ranges of (conversation, turn), and a
node's key is a sum of 128-bit hashes of its turns and their depths; both are prefix sums with a
carry for each (range, conversation), so one conversation may span any number of tasks.

The tree is contracted in join rounds. A round rakes all leaves, which hands their totals to their
parents, and compresses unary chains: a node with one child leaves if its hash of the round is
below its child's and its parent's, so no two neighbours leave together; its child takes over its
place and what it had gathered. A third of each chain goes in a round, so rounds grow with the
logarithm of depth. Nodes that left by compression are expanded again by following what they wait
for, in doubling steps, to a raked node whose total is known. Every join is on keys that occur once
on both sides; only the sums over children meet a hot parent, after partial aggregation.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from excursio.llm import workers
from excursio.shared import write_shared

#: Conversations share the first turns of the one whose id ends in as many zeros.
FAMILY = 100
SHARED_TURNS = 6
RANGE_ROWS = 100_000
#: Rows of a round that go to one task.
ROUND_ROWS = 20_000
#: Ids joined to one piece of text before the pieces of a node are hashed in order.
CHUNK = 256

_PARTS = ["k0", "k1", "k2", "k3"]
_STEPS = ["e0", "e1", "e2", "e3"]
_KEY = ["depth", *_PARTS]
_ID = ["conv_id", "depth"]
_UP = ["up_conv", "up_depth"]
_CHILD = ["child_conv", "child_depth"]


def _zero() -> Column:
    return F.lit(0).cast("long")


def _turn_parts(depth: Column) -> list[Column]:
    """What a turn at this depth adds to the four parts of a node's key."""
    sides = [F.xxhash64(F.lit(side), depth, F.col("sign_a"), F.col("sign_b")) for side in (1, 2)]
    return [half for side in sides for half in (side.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(side, 32))]


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their original place (from 1), and conversations with what they share and keep.

    Turns are ordered by number, null first, and equal numbers by role and text. Rows without a
    ``conv_id`` belong to no conversation and take no part.
    """
    spark = conversations.sparkSession
    plain = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # Equal rows are told apart by their place, or one range would hold them all.
    order = ["conv_id", "turn", "role", "text", "row"]
    ranges = max(math.ceil(plain.count() / RANGE_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = plain.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(ranges, *order)
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    at = F.col("at")
    turns = write_shared(
        dealt.sortWithinPartitions(*order)
        .withColumn("digest", digest)
        .select(
            "conv_id",
            F.monotonically_increasing_id().alias("at"),
            F.conv(F.substring("digest", 1, 15), 16, 10).cast("long").alias("sign_a"),
            F.conv(F.substring("digest", 16, 15), 16, 10).cast("long").alias("sign_b"),
            F.length("text").cast("long").alias("chars"),
        )
        .withColumn("range", F.shiftright(at, 33)),
        "turns",
    )
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    stretches = turns.groupBy("range", "conv_id").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    stretches = stretches.withColumn("before", F.coalesce(F.sum("rows").over(earlier), _zero()))
    lengths = stretches.groupBy("conv_id").agg(F.sum("rows").alias("own_turns"))
    wanted = F.crc32(F.col("conv_id").cast("string")) % SHARED_TURNS
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    base = lengths.select(F.col("conv_id").alias("family"), F.col("own_turns").alias("family_turns"))
    convs = (
        lengths.withColumn("skipped", wanted)
        .withColumn("family", family)
        .join(base, "family", "left")
        .withColumn("heads", F.least("skipped", F.coalesce("family_turns", _zero())))
        .withColumn("turns", F.col("heads") + F.greatest(F.col("own_turns") - F.col("skipped"), _zero()))
        .select("conv_id", "family", "skipped", "heads", "turns")
    )
    convs = write_shared(convs, "conversations")
    placed = turns.join(stretches.join(convs, "conv_id").drop("rows", "family"), ["range", "conv_id"])
    placed = placed.withColumn("place", at - F.col("first") + F.col("before") + 1).drop("at", "first", "before")
    return write_shared(placed, "placed-turns"), convs


def paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each turn of the rebuilt conversations: depth and the keys of the node and its last turn."""
    depth = F.col("depth")
    heads = (
        turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < SHARED_TURNS))
        .select(F.col("conv_id").alias("family"), F.col("place").alias("depth"), "sign_a", "sign_b", "chars")
        .join(convs.select("conv_id", "family", "heads", "turns"), "family")
        .where(depth <= F.col("heads"))
        .select("conv_id", "depth", "turns", "chars", *[p.alias(e) for p, e in zip(_turn_parts(depth), _STEPS)])
    )
    own = turns.where(F.col("place") > F.col("skipped")).withColumn("depth", F.col("place") - F.col("skipped") + F.col("heads"))
    own = own.select("range", "conv_id", "depth", "turns", "chars", *[p.alias(e) for p, e in zip(_turn_parts(depth), _STEPS)])
    started = heads.groupBy("conv_id").agg(*[F.sum(e).alias(f"head_{e}") for e in _STEPS])
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = own.groupBy("range", "conv_id").agg(*[F.sum(e).alias(f"sum_{e}") for e in _STEPS])
    carried = sums.join(started, "conv_id", "left").select(
        "range",
        "conv_id",
        *[(F.coalesce(F.sum(f"sum_{e}").over(earlier), _zero()) + F.coalesce(f"head_{e}", _zero())).alias(f"carry_{e}") for e in _STEPS],
    )
    so_far = Window.partitionBy("range", "conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    columns = ["conv_id", "depth", "turns", "chars", *_STEPS]
    of_own = own.join(carried, ["range", "conv_id"]).select(
        *columns, *[(F.sum(e).over(so_far) + F.col(f"carry_{e}")).alias(k) for e, k in zip(_STEPS, _PARTS)]
    )
    in_head = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    of_heads = heads.select(*columns, *[F.sum(e).over(in_head).alias(k) for e, k in zip(_STEPS, _PARTS)])
    return write_shared(of_own.unionByName(of_heads), "paths")


def tree(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """All nodes: smallest member, depth, key, parent, members, children and what the node itself saves."""
    nodes = paths.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("chars").alias("chars"),
        *[F.min(e).alias(e) for e in _STEPS],
    )
    nodes = write_shared(nodes, "nodes")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where(F.col("n_convs") > 0)
    above = [F.col("conv_id").alias("up_conv"), F.col("depth").alias("up_depth"), *[F.col(k).alias(f"up_{k}") for k in _PARTS]]
    below = nodes.withColumn("up_depth", F.col("depth") - 1)
    below = below.select("*", *[(F.col(k) - F.col(e)).alias(f"up_{k}") for k, e in zip(_PARTS, _STEPS)])
    deep = below.where(F.col("depth") > 1).join(nodes.select(*above), ["up_depth", *[f"up_{k}" for k in _PARTS]])
    first = below.where(F.col("depth") == 1).crossJoin(F.broadcast(root.select(F.col("conv_id").alias("up_conv"))))  # one row
    columns = [*_KEY, "conv_id", *_UP, "n_convs", "chars"]
    top = root.select(
        *[_zero().alias(k) for k in _KEY], "conv_id", *[F.lit(None).cast("long").alias(k) for k in _UP], "n_convs", _zero().alias("chars")
    )
    linked = write_shared(deep.select(*columns).unionByName(first.select(*columns)).unionByName(top), "linked")
    kids = linked.where(F.col("up_conv").isNotNull()).groupBy(*_UP).agg(F.count("*").alias("n_children"))
    kids = kids.select(F.col("up_conv").alias("conv_id"), F.col("up_depth").alias("depth"), "n_children")
    known = linked.join(kids, _ID, "left").withColumn("n_children", F.coalesce("n_children", _zero()))
    return write_shared(known.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")), "tree")


def _renamed(names: list[str], new: list[str]) -> list[Column]:
    return [F.col(a).alias(b) for a, b in zip(names, new)]


def _round(number: int, left: DataFrame, given: DataFrame | None, values: list[str], tasks: int) -> DataFrame:
    """One round over the nodes ``left``; ``given`` is what was raked before, to be handed on first.

    The result says what becomes of each node (``fate``): ``raked`` with its total in ``values``,
    ``spliced`` with what it adds to the total of the child it waits for, or ``inner``.
    """
    if given is not None:
        handed = given.where(F.col("up_conv").isNotNull()).groupBy(*_UP)
        handed = handed.agg(*[F.sum(F.col(v) + F.col(f"edge_{v}")).alias(f"got_{v}") for v in values])
        left = left.join(handed.withColumnsRenamed(dict(zip(_UP, _ID))), _ID, "left")
        left = left.withColumns({v: F.col(v) + F.coalesce(f"got_{v}", _zero()) for v in values}).drop(*[f"got_{v}" for v in values])
    kids = left.where(F.col("up_conv").isNotNull()).groupBy(*_UP)
    kids = kids.agg(
        F.count("*").alias("kids"),
        *[F.min(a).alias(b) for a, b in zip(_ID, _CHILD)],
        *[F.sum(f"edge_{v}").alias(f"child_{v}") for v in values],
    ).withColumnsRenamed(dict(zip(_UP, _ID)))
    own, child, up = (F.xxhash64(F.lit(number), *names) for names in (_ID, _CHILD, _UP))
    fate = F.when(F.col("kids").isNull(), "raked")
    fate = fate.when((F.col("kids") == 1) & F.col("up_conv").isNotNull() & (own < child) & (own < up), "spliced").otherwise("inner")
    seen = left.join(kids, _ID, "left").withColumn("fate", fate)
    spliced = seen.where(F.col("fate") == "spliced")
    moved = spliced.select(
        *_renamed(_CHILD, _ID),
        *_renamed(_UP, ["new_conv", "new_depth"]),
        *[(F.col(v) + F.col(f"edge_{v}")).alias(f"more_{v}") for v in values],
    )
    rest = seen.where(F.col("fate") != "spliced").join(moved, _ID, "left")
    rest = rest.select(
        *_ID,
        *[F.coalesce(a, b).alias(b) for a, b in zip(["new_conv", "new_depth"], _UP)],
        *values,
        *[(F.col(f"edge_{v}") + F.coalesce(f"more_{v}", _zero())).alias(f"edge_{v}") for v in values],
        *_CHILD,
        "fate",
    )
    gone = spliced.select(
        *_ID, *_UP, *[(F.col(v) + F.col(f"child_{v}")).alias(v) for v in values], *[f"edge_{v}" for v in values], *_CHILD, "fate"
    )
    return write_shared(rest.unionByName(gone).coalesce(tasks), f"round-{number}")


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Sums of ``values`` over every node's subtree, itself included.

    ``nodes`` has ``conv_id`` and ``depth`` (together unique), ``up_conv`` and ``up_depth`` (null for
    roots) and the values, whole numbers. Any forest will do; an empty one gives an empty result.
    """
    left = nodes.select(*_ID, *_UP, *values, *[_zero().alias(f"edge_{v}") for v in values])
    rows, given, rounds = nodes.count(), None, []
    while rows:
        done = _round(len(rounds), left, given, values, math.ceil(rows / ROUND_ROWS))
        rounds.append(done)
        left, given = done.where(F.col("fate") == "inner").drop(*_CHILD, "fate"), done.where(F.col("fate") == "raked")
        rows = left.count()
    if not rounds:
        return nodes.select(*_ID, *values)
    every = rounds[0]
    for more in rounds[1:]:
        every = every.unionByName(more)
    raked = every.where(F.col("fate") == "raked").select(*_ID, *values)
    waiting = every.where(F.col("fate") == "spliced").select(*_ID, *_CHILD, *values)
    # A node waits for one that left in a later round, or was raked in the same: at most a step a round.
    further = [f"next_{n}" for n in _CHILD]
    for _ in range(math.ceil(math.log2(len(rounds) + 1))):
        waiting = write_shared(waiting, "waiting")
        ahead = waiting.select(*_renamed(_ID, _CHILD), *_renamed(_CHILD, further), *[F.col(v).alias(f"ahead_{v}") for v in values])
        waiting = waiting.join(ahead, _CHILD, "left").select(
            *_ID,
            *[F.coalesce(a, b).alias(b) for a, b in zip(further, _CHILD)],
            *[(F.col(v) + F.coalesce(f"ahead_{v}", _zero())).alias(v) for v in values],
        )
    ends = raked.select(*_renamed(_ID, _CHILD), *[F.col(v).alias(f"end_{v}") for v in values])
    expanded = waiting.join(ends, _CHILD).select(*_ID, *[(F.col(v) + F.col(f"end_{v}")).alias(v) for v in values])
    return raked.unionByName(expanded)


def _strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ids of sorted rows, comma-joined by node, at most ``CHUNK`` to a row."""
    key, ids = None, []

    def row() -> tuple:
        return (*key, ids[0], ",".join(map(str, ids)))

    for batch in batches:
        out = []
        for *own, conv_id in batch[[*_KEY, "conv_id"]].itertuples(index=False, name=None):
            if ids and (own != key or len(ids) == CHUNK):
                out.append(row())
                ids = []
            key = own
            ids.append(conv_id)
        yield pd.DataFrame(out, columns=[*_KEY, "first", "ids"])
    if ids:
        yield pd.DataFrame([row()], columns=[*_KEY, "first", "ids"])


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hash of each node's pieces, which come in order."""
    key, digest = None, None
    for batch in batches:
        out = []
        for *own, ids in batch[[*_KEY, "ids"]].itertuples(index=False, name=None):
            if own != key:
                if digest is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = own, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pd.DataFrame(out, columns=[*_KEY, "ends_sha256"])
    if digest is not None:
        yield pd.DataFrame([(*key, digest.hexdigest())], columns=[*_KEY, "ends_sha256"])


def ends(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at a node.

    Ids are written out in ranges, so a hot node's text is made by many tasks; only the hash, which
    is sequential, runs over a node's pieces in one, and streams them.
    """
    workers.ready(paths.sparkSession)
    last = paths.where(F.col("depth") == F.col("turns")).select(*_KEY, "conv_id")
    turnless = convs.where(F.col("turns") == 0).select(*[_zero().alias(k) for k in _KEY], "conv_id")
    every = write_shared(last.unionByName(turnless), "ends")
    parts = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = every.repartitionByRange(max(parts, math.ceil(every.count() / RANGE_ROWS)), *_KEY, "conv_id")
    key = ", ".join(f"{k} long" for k in _KEY)
    pieces = ranged.sortWithinPartitions(*_KEY, "conv_id").mapInPandas(_strings, f"{key}, first long, ids string")
    pieces = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "first")
    return pieces.mapInPandas(_hashed, f"{key}, ends_sha256 string")


def prefix_tree(conversations: DataFrame) -> DataFrame:
    """Every node of the trie of rebuilt conversations, from the textless root.

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``; further columns aren't read. Null
    role or text counts as empty; rows without ``conv_id`` take no part; a repeated row is one more
    turn; texts of any length are compared whole, by hash. An empty table has no node, not even a root.
    """
    turns, convs = numbered_turns(conversations)
    found = paths(turns, convs)
    nodes = tree(found, convs)
    own = nodes.select(*_ID, *_UP, F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    totals = subtree_totals(own, ["n_leaves", "saved_tokens"])
    joined = nodes.join(totals, _ID).join(ends(found, convs), _KEY, "left")
    return joined.select(
        "conv_id",
        "depth",
        F.col("up_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


SQL = r"""
WITH crc_table AS (
    SELECT list_transform(range(256), lambda b: list_reduce(
        [b] || range(8), lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS cells
),
original AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                         ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
wanted AS (
    SELECT conv_id, turns, conv_id - conv_id % 100 AS family, xor(list_reduce(
        [4294967295::BIGINT] || list_transform(range(1, length(conv_id::VARCHAR) + 1),
            lambda i: ascii(substr(conv_id::VARCHAR, i::BIGINT, 1))::BIGINT),
        lambda crc, byte: xor(crc >> 8, cells[(xor(crc, byte) & 255) + 1]::BIGINT)), 4294967295) % 6 AS h
    FROM original, crc_table
),
rebuilt AS (
    SELECT w.conv_id, coalesce(b.turns[1:w.h], []) || w.turns[w.h + 1:] AS turns
    FROM wanted w LEFT JOIN original b ON b.conv_id = w.family
),
paths AS (
    SELECT conv_id, d AS depth, turns[1:d] AS prefix, len(turns) = d AS ends
    FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
),
nodes AS (
    SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
           (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE length(prefix[depth].text) END AS saved
    FROM paths GROUP BY prefix, depth
),
members AS (
    SELECT p.conv_id AS member, n.conv_id, n.depth FROM paths p JOIN nodes n ON n.prefix = p.prefix AND n.depth = p.depth
),
linked AS (
    SELECT n.*, m.conv_id AS parent_conv_id
    FROM nodes n LEFT JOIN members m ON m.member = n.conv_id AND m.depth = n.depth - 1
),
children AS (
    SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children
    FROM linked WHERE depth > 0 GROUP BY ALL
),
known AS (
    SELECT l.*, coalesce(c.n_children, 0) AS n_children FROM linked l LEFT JOIN children c USING (conv_id, depth)
),
totals AS (
    SELECT m.conv_id, m.depth, sum(CASE WHEN k.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(k.saved) AS saved_tokens
    FROM known k JOIN members m ON m.member = k.conv_id AND m.depth <= k.depth GROUP BY ALL
)
SELECT conv_id, depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM known JOIN totals USING (conv_id, depth)
"""
