"""Packing examples into sequences: vector bin packing by the dot-product heuristic.

An example has three sizes: tokens, segments (one) and loss-bearing tokens; a sequence has a
limit for each. Sequences are filled one after the other: of the examples that still fit, the
next is the one whose sizes, weighted by how scarce each is, have the largest dot product with
the room that is left. Examples of equal sizes are interchangeable, so a lane is packed over
counts of distinct sizes.

Examples are dealt out evenly to lanes of a bounded number of examples; a lane is packed by one
task, and at most its last sequences are left with room.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from excursio.llm import textbytes, workers
from excursio.shared import write_shared

SEQUENCE = 1024
SEGMENTS = 128
END = 0
LANE = 20_000


class Encoder:
    """The ids of a ``tokenizers`` file; with the same vocabulary as ranks, by ``tiktoken``.

    ``tiktoken`` gives the same ids several times as fast. A text that it can't take, or that
    names a special token, goes to ``tokenizers`` itself.
    """

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(tokenizer)
        self._special = [t.content for t in self._whole.get_added_tokens_decoder().values()]
        self._fast = None
        if ranks and pattern:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self._fast is not None and not any(s in text for s in self._special):
            try:
                return self._fast.encode_ordinary(text)
            except BaseException as error:  # the pattern's stack overflows on some texts
                if isinstance(error, (KeyboardInterrupt, SystemExit)):
                    raise
        return self._whole.encode(text, add_special_tokens=False).ids


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(*files: str | None) -> Encoder:
    """The worker's encoder for these files."""
    if files not in _ENCODERS:
        _ENCODERS[files] = Encoder(*files)
    return _ENCODERS[files]


def public_files() -> tuple[str, str, str]:
    """Files and pattern of the public byte-level vocabulary."""
    import public_tokenizers

    path = public_tokenizers.path
    return path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _pieces(files: tuple, sequence: int):
    def pieces(batches):
        coder, part = encoder(*files), TaskContext.get().partitionId()
        number = 0
        for batch in batches:
            texts, doc_ids = batch["text"].tolist(), batch["doc_id"].tolist()
            for some in textbytes.slices(texts):
                out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "deal")}
                for doc_id, text in zip(doc_ids[some], texts[some]):
                    ids = np.array([*coder.encode(text if isinstance(text, str) else ""), END], "<u4")
                    number += 1
                    for start in range(0, len(ids), sequence):
                        piece = ids[start : start + sequence]
                        out["doc_id"].append(int(doc_id) if isinstance(doc_id, str) else None)
                        out["start"].append(start)
                        out["length"].append(len(piece))
                        out["ids_crc32"].append(zlib.crc32(piece.tobytes()))
                        out["doc_tokens"].append(len(ids))
                        # Spreads pieces evenly over lanes whatever their ids and sizes are.
                        out["deal"].append((part * 1_000_003 + number * 7919 + start // sequence) & 0x7FFFFFFF)
                frame = pd.DataFrame(out)
                frame["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
                yield frame

    return pieces


def pieces(docs: DataFrame, files: tuple | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """Tokenise whole texts, end each with id 0 and cut it into pieces of ``sequence`` tokens.

    Null text counts as empty and gives one piece, the id 0. One row per piece: ``doc_id``,
    ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` and ``deal``, a number to deal pieces out by.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, deal long"
    workers.ready(docs.sparkSession)
    # A null id becomes NaN among integers of a batch, so ids travel as text.
    plain = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return plain.mapInPandas(_pieces(files or public_files(), sequence), schema)


def place(sizes: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Bin of each example: rows of ``sizes`` (tokens, segments, loss) under ``limits``.

    Examples that exceed a limit by themselves get a bin each.
    """
    kinds, kind, left = np.unique(sizes, axis=0, return_inverse=True, return_counts=True)
    kind = kind.reshape(-1)
    # An example of the scarcest size weighs most: how much of a limit all examples ask for.
    weight = sizes.sum(0) / limits / np.maximum(limits, 1)
    pull = kinds * weight
    order: list[list[int]] = [[] for _ in kinds]
    used, room, fits = 0, limits.astype(np.float64).copy(), (kinds <= limits).all(1)
    for k in np.flatnonzero(~fits):
        order[k] = list(range(used, used + left[k]))
        used += left[k]
    open_kinds = np.flatnonzero(fits)
    while len(open_kinds):
        own = kinds[open_kinds]
        able = np.flatnonzero((own <= room).all(1))
        if not len(able):
            used, room = used + 1, limits.astype(np.float64).copy()
            continue
        best = open_kinds[able[np.argmax(pull[open_kinds[able]] @ room)]]
        order[best].append(used)
        room -= kinds[best]
        left[best] -= 1
        if not left[best]:
            open_kinds = open_kinds[open_kinds != best]
    out = np.empty(len(sizes), np.int64)
    taken = np.zeros(len(kinds), np.int64)
    for row, k in enumerate(kind):
        out[row] = order[k][taken[k]]
        taken[k] += 1
    return out


def _packed(limits: tuple[int, int, int]):
    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        # Rows come in any order after a shuffle; equal rows are interchangeable.
        rows = rows.sort_values(["deal", "doc_id", "start", "ids_crc32"], kind="stable", ignore_index=True)
        sizes = np.column_stack([rows["length"], np.ones(len(rows), np.int64), rows["loss"]])
        bins = place(sizes, np.array(limits, np.int64))
        rows["sequence_id"] = (rows["lane"].to_numpy(np.int64) << 32) + bins
        order = np.lexsort([rows["start"].to_numpy(), rows["deal"].to_numpy(), bins])
        rows = rows.iloc[order].reset_index(drop=True)
        rows["offset"] = rows.groupby("sequence_id")["length"].cumsum() - rows["length"]
        return rows.drop(columns=["lane", "deal"])

    return packed


def pack(
    examples: DataFrame,
    *,
    sequence: int = SEQUENCE,
    segments: int = SEGMENTS,
    loss_tokens: int | None = None,
    per_lane: int = LANE,
) -> DataFrame:
    """Assign each example to a sequence, and its place there.

    ``examples`` has the columns of ``pieces`` and, if wanted, ``loss`` (loss-bearing tokens; by
    default every token is one). No sequence has more than ``sequence`` tokens, ``segments``
    examples or ``loss_tokens`` loss-bearing tokens. Adds ``sequence_id`` and ``offset``, gapless from 0 in
    each sequence. Full pieces are sequences of their own. Repeated rows are examples of their own; an
    empty table gives an empty result.
    """
    workers.ready(examples.sparkSession)
    if "loss" not in examples.columns:
        examples = examples.withColumn("loss", F.col("length"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "loss", "deal"]
    # Written before it is dealt out: the lanes of a piece stay the same if a task is repeated.
    held = write_shared(examples.select(*names), "pieces")
    lanes = max(1, -(-held.count() // per_lane))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss long, sequence_id long, offset long"
    limits = (sequence, segments, sequence if loss_tokens is None else loss_tokens)
    dealt = held.withColumn("lane", F.pmod(F.xxhash64("deal"), F.lit(lanes)))
    return dealt.groupBy("lane").applyInPandas(_packed(limits), schema)


def pack_documents(docs: DataFrame) -> DataFrame:
    """Tokenise, cut and pack whole documents; every token of every row is in exactly one piece."""
    return pack(pieces(docs)).drop("loss")
