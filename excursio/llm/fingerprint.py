"""Document fingerprints by consistent weighted sampling.

A text is a multiset of words; a word's weight ``S`` is how often it occurs. Sample ``j`` draws
for every word, from hashes of word and ``j`` alone, ``r`` and ``c`` ~ Gamma(2, 1) and ``b``
uniform, and sets ``t = floor(ln S / r + b)``, ``ln y = r (t - b)``, ``ln a = ln c - ln y - r``.
The word with the least ``a`` is the sample, together with its ``t``. Two texts have equal
samples with a probability that is the generalised Jaccard similarity of their multisets,
``sum min(S, S') / sum max(S, S')``.

Everything is column expressions: words are exploded and counted per text, then each sample is
one ``min`` over a long that holds ``ln a`` in its upper and the sample's name in its lower half.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Runs of the six ASCII white-space characters part words.
SPACE = r"[\x09-\x0D\x20]+"
SAMPLES = 32
#: Stands for a sample of a text without words; no sample's name equals it.
NOTHING = 2**32 - 1

_UNIT = float(2**24)


def _uniform(bits: Column, shift: int) -> Column:
    """A number inside (0, 1) from 24 bits of a hash."""
    return (F.shiftrightunsigned(bits, shift).bitwiseAND(2**24 - 1) + F.lit(0.5)) / F.lit(_UNIT)


def _packed(log_a: Column, name: Column) -> Column:
    scaled = F.floor((F.least(F.greatest(log_a, F.lit(-60.0)), F.lit(67.0)) + 60.0) * _UNIT)
    return scaled * F.lit(2**32) + F.pmod(name, F.lit(NOTHING))


def _sample(term: Column, log_weight: Column, j: int) -> Column:
    """``ln a`` of a term in sample ``j`` as fixed-point number above the name of (term, t).

    A gamma number is ``-ln(u u')``; the uniform numbers are bits of two hashes. Most words occur
    once in a text, and then ``t`` is 0, which leaves ``ln a = ln c - r (1 - b)``.
    """
    one = F.xxhash64(term, F.lit(2 * j))
    two = F.xxhash64(term, F.lit(2 * j + 1))
    r = -F.ln(_uniform(one, 0) * _uniform(one, 24))
    log_c = F.ln(-F.ln(_uniform(two, 0) * _uniform(two, 24)))
    # The last uniform number takes the bits that the others left over.
    b = (F.shiftrightunsigned(one, 48) * 256 + F.shiftrightunsigned(two, 56) + F.lit(0.5)) / F.lit(_UNIT)
    once = _packed(log_c - r * (F.lit(1.0) - b), two)
    t = F.floor(log_weight / r + b)
    # Below 2**63: t in 20 bits by a multiplier of 42.
    moved = two.bitwiseXOR(t.bitwiseAND(2**20 - 1) * F.lit(0x3C6EF372FE9))
    return F.when(log_weight == 0, once).otherwise(_packed(log_c - r * (t - b) - r, moved))


def words(text: Column) -> Column:
    """All words of a text in order, repeats included; an array that may hold empty strings."""
    return F.split(F.coalesce(text, F.lit("")), SPACE)


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """One row for each distinct ``keys``: ``keys`` and ``signature``, an array of ``samples`` longs.

    All rows with equal keys are one text. A null text, or one without words, has a signature of
    ``NOTHING``. If ``texts`` is already distributed by some of the keys, nothing is shuffled.
    """
    terms = texts.select(*keys, F.explode(words(F.col(text))).alias("_word"))
    terms = terms.select(*keys, F.when(F.col("_word") != "", F.xxhash64("_word")).alias("_term"))
    weighted = terms.groupBy(*keys, "_term").agg(F.count("_term").alias("_weight"))
    weighted = weighted.withColumn("_log", F.when(F.col("_weight") > 0, F.ln("_weight")))
    # Of terms with a null weight every sample is null, and min() passes over it.
    drawn = weighted.groupBy(*keys).agg(
        *[F.min(_sample(F.col("_term"), F.col("_log"), j)).alias(f"_s{j}") for j in range(samples)]
    )
    names = [F.coalesce(F.col(f"_s{j}").bitwiseAND(NOTHING), F.lit(NOTHING)) for j in range(samples)]
    return drawn.select(*keys, F.array(*names).alias("signature"))


def printed(signature: Column, samples: int = SAMPLES) -> Column:
    """A signature as text: eight hexadecimal digits for each sample."""
    return F.lower(F.concat(*[F.lpad(F.hex(signature[j]), 8, "0") for j in range(samples)]))


def likeness(left: Column, right: Column, samples: int = SAMPLES) -> Column:
    """The share of equal samples, an estimate of the generalised Jaccard similarity."""
    equal = [F.when(left[j] == right[j], 1).otherwise(0) for j in range(samples)]
    return reduce(lambda a, b: a + b, equal) / F.lit(float(samples))


def _literal(numbers: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<long>")


def _at_or_below(at: Column, cuts: list[int]) -> Column:
    """How many of the ascending ``cuts`` are at or below ``at``: first in steps, then in one step."""
    if not cuts:
        return F.lit(0)
    step = max(1, round(len(cuts) ** 0.5))
    coarse = F.size(F.filter(_literal(cuts[::step]), lambda c: c <= at))
    begin = F.greatest(coarse - 1, F.lit(0)) * step
    fine = F.size(F.filter(F.slice(_literal(cuts), begin + 1, step), lambda c: c <= at))
    return begin + fine


def in_ranges(docs: DataFrame, rows_per_range: int = 500, max_ranges: int = 20_000) -> DataFrame:
    """Deal documents out by ranges of ``doc_id``, each with the first row of the next as a guest.

    The ids are cut at quantiles into ranges of about ``rows_per_range`` rows, at most
    ``max_ranges`` (beyond that ranges grow). Within a range ordered by (``_guest``, ``_at``)
    every row is followed by its successor; the first row of all is the last range's guest.
    Adds ``_range``, ``_at`` (the id, null as the largest) and ``_guest``.
    """
    placed = docs.withColumn("_at", F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)))
    facts = placed.agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("low")).first()
    ranges = min(max(1, -(-facts["n"] // rows_per_range)), max_ranges)
    cuts: list[int] = []
    if ranges > 1:
        shares = [k / ranges for k in range(1, ranges)]
        found = placed.agg(F.percentile_approx("_at", shares, max(10_000, 4 * ranges))).first()[0]
        cuts = sorted({c for c in found if c > facts["low"]})
    placed = placed.withColumn("_own", _at_or_below(F.col("_at"), cuts))
    first = _literal([facts["low"] or 0, *cuts])
    before = F.pmod(F.col("_own") - 1, F.lit(len(cuts) + 1))
    seat = F.struct(F.col("_own").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(before.alias("range"), F.lit(True).alias("guest"))
    seats = F.when(first[F.col("_own")] == F.col("_at"), F.array(seat, guest)).otherwise(F.array(seat))
    return placed.withColumn("_seat", F.explode(seats)).select(
        F.col("_seat.range").alias("_range"), F.col("_seat.guest").alias("_guest"), "_at", *docs.columns
    )


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprint each document and its edited text, and compare.

    The edited text has the last ``floor(n_chars / 2)`` characters replaced by as many (or all)
    from the start of the next document: the following one by ``doc_id``, after the last the
    first. One shuffle deals the texts out by ranges of ids; everything else stays in place.

    Null texts count as empty; texts without words are alike. Null ids come last. Rows with equal
    ids follow each other by text; repeated rows each get a result, and one of them is followed by
    the other. A single row follows itself. An empty table gives an empty result. Of other
    columns nothing is used.
    """
    order = Window.partitionBy("_range").orderBy("_guest", "_at", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    lined = (
        in_ranges(docs.select("doc_id", text.alias("text")))
        .withColumn("_row", F.row_number().over(order))
        .withColumn("_next", F.coalesce(F.lead("text").over(order), F.lit("")))
    )
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), size - half), F.substring(F.col("_next"), F.lit(1), half))
    facts = F.struct(
        F.col("doc_id"),
        F.col("_guest").alias("guest"),
        size.cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
    )
    kind = "struct<kind:int,text:string,facts:struct<doc_id:bigint,guest:boolean,n_chars:bigint,edited_sha256:string>>"
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text"), F.lit(None).alias("facts")).cast(kind),
        F.struct(F.lit(1).alias("kind"), F.col("_edited").alias("text"), F.lit(None).alias("facts")).cast(kind),
        F.struct(F.lit(2).alias("kind"), F.lit("").alias("text"), facts.alias("facts")).cast(kind),
    )
    # What describes a row rides on a text of its own, so that its words don't carry it.
    texts = (
        lined.withColumn("_edited", edited)
        .select("_range", "_row", F.explode(kinds).alias("_each"))
        .select("_range", "_row", "_each.*")
    )
    drawn = fingerprints(texts, ["_range", "_row", "kind", "facts"], samples=samples)
    rows = drawn.groupBy("_range", "_row").agg(
        *[
            F.first(F.when(F.col("kind") == k, F.col(name)), ignorenulls=True).alias(to)
            for k, name, to in ((0, "signature", "_own"), (1, "signature", "_edited"), (2, "facts", "_facts"))
        ]
    )
    following = Window.partitionBy("_range").orderBy("_row")
    return (
        rows.withColumn("_next", F.coalesce(F.lead("_own").over(following), F.col("_own")))
        .where(~F.col("_facts.guest"))
        .select(
            "_facts.doc_id",
            "_facts.n_chars",
            "_facts.edited_sha256",
            printed(F.col("_own"), samples).alias("fingerprint"),
            printed(F.col("_edited"), samples).alias("edited_fingerprint"),
            likeness(F.col("_own"), F.col("_edited"), samples).alias("near_edited"),
            likeness(F.col("_own"), F.col("_next"), samples).alias("near_next"),
        )
    )
