"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard has virtual nodes on a ring. A document's place on the ring comes from its text, so
equal texts start at the same place. Documents arrive in an order drawn from their ids and go
to the first shard clockwise that isn't full; a shard is full at its share of the rows, so counts
end at most one apart. A new shard takes over arcs of the ring; what else moves is the overflow.

The order of arrival is cut into phases by the moments at which a shard fills up. Within a phase
a document's shard depends only on its place on the ring, so there are at most as many phases as
shards; each moment is found with one count per shard and stretch of arrivals and one look into
the stretch, and the final assignment is an expression of place and arrival.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from excursio import shared

#: Places on the ring, a power of two.
PLACES = 1 << 13
_FIRST_SIGN = 0x100


def _sign(shard: int) -> str:
    return chr(_FIRST_SIGN + shard)


def clockwise(shards: int, virtual_nodes: int = 64) -> list[str]:
    """For each place on the ring all shards in the order in which they are met clockwise.

    A shard is one character. Nodes on the same place are met in the order of their digests.
    """
    nodes = sorted(
        (int.from_bytes(digest[:2], "big") % PLACES, digest, shard)
        for shard in range(shards)
        for k in range(virtual_nodes)
        if (digest := hashlib.sha256(f"{shard}/{k}".encode()).digest())
    )
    out, at = [], 0
    for place in range(PLACES):
        while at < len(nodes) and nodes[at][0] < place:
            at += 1
        met: dict[int, None] = {}
        for k in range(len(nodes)):
            met.setdefault(nodes[(at + k) % len(nodes)][2])
            if len(met) == shards:
                break
        out.append("".join(map(_sign, met)))
    return out


def place(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text), 64 - (PLACES.bit_length() - 1)).cast("int")


def _numbered(rows: DataFrame, by: list[str], stretch: str, order: list[str], to: str) -> DataFrame:
    """Number rows from 0 within ``by`` in the order of (``stretch``, ``order``).

    Rows are numbered within their stretch, and each stretch goes on where the one before ended.
    """
    own = rows.withColumn("_own", F.row_number().over(Window.partitionBy(*by, stretch).orderBy(*order)) - 1)
    counts = rows.groupBy(*by, stretch).agg(F.count(F.lit(1)).alias("_count"))
    along = Window.partitionBy(*by).orderBy(stretch).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, stretch, F.coalesce(F.sum("_count").over(along), F.lit(0)).alias("_start"))
    joined = own.join(starts, [*by, stretch])
    return joined.withColumn(to, F.col("_start") + F.col("_own")).drop("_own", "_start")


def shard(
    docs: DataFrame, shards: int = 8, virtual_nodes: int = 64, rows_per_stretch: int = 5000
) -> DataFrame:
    """The shard of every document, and its slot there; counts of shards are at most one apart.

    Returns ``doc_id``, ``size`` (UTF-8 bytes of the text and one more), ``text_crc32``,
    ``shard`` and ``slot`` (gapless from 0). A null text counts as empty and has the CRC of
    nothing; a null id is an id like another. Repeated rows arrive one after the other and may
    part at the moment their shard fills up; they are interchangeable. An empty table gives an
    empty result. Other columns aren't read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    drawn = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text, F.lit(11))
    count = docs.count()
    stretches = max(1, -(-count // rows_per_stretch))
    light = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        place(text).alias("_place"),
        drawn.alias("_draw"),
    ).withColumn("_stretch", F.floor((F.col("_draw") / float(2**64) + 0.5) * stretches).cast("long"))
    # Rows that agree in all of these are interchangeable, whichever arrives first.
    light = _numbered(light, [], "_stretch", ["_draw", "doc_id", "size", "text_crc32"], "_arrival")
    arrivals = shared.write_shared(light.drop("_draw"), "arrivals")

    orders = F.split(F.lit(",".join(clockwise(shards, virtual_nodes))), ",")
    room = {k: count // shards + (k < count % shards) for k in range(shards)}
    full, begin = "".join(_sign(k) for k in room if not room[k]), 0
    phases = [(0, full)]
    open_rows = arrivals.withColumn("_order", orders[F.col("_place")])
    while len(full) < shards - 1 and begin < count:
        ahead = open_rows.where(F.col("_arrival") >= begin).withColumn("_shard", _first_open(F.col("_order"), full))
        begin, filled, arrived = _next_full(ahead, {_sign(k): room[k] for k in room if _sign(k) not in full})
        for k in room:
            room[k] -= arrived.get(_sign(k), 0)
        full += "".join(filled)
        phases.append((begin, full))
    now = F.lit(phases[0][1])
    for start, signs in phases[1:]:
        now = F.when(F.col("_arrival") >= start, F.lit(signs)).otherwise(now)
    landed = open_rows.withColumn("_shard", _first_open(F.col("_order"), now)).withColumn(
        "shard", (F.expr("ascii(_shard)") - _FIRST_SIGN).cast("int")
    )
    slotted = _numbered(landed, ["shard"], "_stretch", ["_arrival"], "slot")
    return slotted.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))


def _first_open(order: Column, full: Column | str) -> Column:
    signs = F.lit(full) if isinstance(full, str) else full
    return F.substring(F.call_function("translate", order, signs, F.lit("")), 1, 1)


def _next_full(ahead: DataFrame, room: dict[str, int]) -> tuple[int, list[str], dict[str, int]]:
    """When the next shard is full: the arrival after that, who is full then, and who got how many."""
    rooms = F.create_map(*[F.lit(x) for sign in room for x in (sign, room[sign])])
    along = Window.partitionBy("_shard").orderBy("_stretch")
    totals = (
        ahead.groupBy("_shard", "_stretch")
        .count()
        .withColumn("_sum", F.sum("count").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    )
    stretch = totals.where(F.col("_sum") >= rooms[F.col("_shard")]).agg(F.min("_stretch")).first()[0]
    earlier = {
        r["_shard"]: r["n"]
        for r in totals.where(F.col("_stretch") < stretch).groupBy("_shard").agg(F.max("_sum").alias("n")).collect()
    }
    left = F.create_map(*[F.lit(x) for sign in room for x in (sign, room[sign] - earlier.get(sign, 0))])
    inside = ahead.where(F.col("_stretch") == stretch).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_shard").orderBy("_arrival"))
    )
    end = inside.where(F.col("_rank") == left[F.col("_shard")]).agg(F.min("_arrival")).first()[0]
    arrived = {
        r["_shard"]: r["count"]
        for r in inside.where(F.col("_arrival") <= end).groupBy("_shard").count().collect()
    }
    got = {sign: earlier.get(sign, 0) + arrived.get(sign, 0) for sign in room}
    return end + 1, [sign for sign in room if got[sign] == room[sign]], got
