"""Byte-level BPE in batched merge rounds over numpy arrays.

The symbols of many words lie in one flat array. In each round the rank of a pair of neighbours
is found by binary search in the sorted pair keys, every word merges all occurrences of its own
lowest-ranked pair, and words in which no pair is left leave the array. Ranks are looked up anew
only next to a merge. A pair's symbol is made by one merge only, so all pairs that a merge gives
rise to rank after it, and merging every occurrence at once equals merging one by one.

The vocabulary is read on the driver and broadcast (a few MB), so workers need no file.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from excursio.llm import textbytes, workers

#: How a byte-level vocabulary cuts a text into words (fixed value), over classes of characters.
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
#: Texts below this code point are cut by the standard library, over ranges written out.
LOW = 0x250
#: Words a task remembers between batches; then it starts over.
REMEMBERED = 1 << 17
_SLICE = 1 << 20
_NONE = np.int64(1) << 40


@dataclass(frozen=True)
class Vocabulary:
    """Pair keys in ascending order with rank and merged id; bytes of all ids; special tokens."""

    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    byte_ids: np.ndarray
    token_bytes: np.ndarray
    token_starts: np.ndarray
    special: dict[str, int]
    #: Letters and digits here that the tokenizer's own, older Unicode tables don't know.
    unknown: str = ""


def _alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def read_vocabulary(path: str) -> Vocabulary:
    """Read a ``tokenizers`` file of plain byte-level BPE.

    Truncation and padding are not used. Settings that this encoder doesn't follow raise
    ``ValueError``: a normalizer, dropout, an unknown token, a prefix space, another model.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type", "BPE") == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and spec.get("normalizer") is None
        and cut.get("type") == "ByteLevel"
        and cut.get("use_regex", True)
        and not cut.get("add_prefix_space")
    )
    added = spec.get("added_tokens") or []
    if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
    ids, alphabet = model["vocab"], _alphabet()
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    keys = np.array([(ids[a] << 32) | ids[b] for a, b in pairs], np.int64).reshape(-1)
    merged = np.array([ids[a + b] for a, b in pairs], np.int64).reshape(-1)
    if len(np.unique(merged)) != len(merged):
        raise ValueError(f"{path}: a token is made by several merges")
    order = np.argsort(keys, kind="stable")
    special = {t["content"]: t["id"] for t in added}
    spelled = {i: t for t, i in [*ids.items(), *special.items()]}
    parts = [_spelling(spelled.get(i, ""), alphabet) for i in range(max(spelled, default=-1) + 1)]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=starts[1:])
    symbols = {b: c for c, b in alphabet.items()}
    return Vocabulary(
        keys[order],
        order.astype(np.int64),
        merged[order],
        np.array([ids[symbols[b]] for b in range(256)], np.int64),
        np.frombuffer(b"".join(parts), np.uint8),
        starts,
        special,
        _unknown(path),
    )


def _unknown(path: str) -> str:
    from tokenizers import Tokenizer

    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    recent = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn"]
    known = regex.compile(r"(\p{L})|(\p{N})")
    return "".join(c for c in recent if (m := known.match(c)) and len(cut(("a" if m[1] else "1") + c)) > 1)


def _ranges(characters: Iterable[str]) -> str:
    """The inside of a character class."""
    runs: list[list[int]] = []
    for code in sorted(map(ord, characters)):
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


class Cutter:
    """Cuts texts into words, by the same pattern over three ways to state its classes."""

    def __init__(self, unknown: str = ""):
        classes = {"L": r"\p{L}", "N": r"\p{N}", "S": r"\s"}
        low = {k: [c for c in map(chr, range(LOW)) if regex.match(v, c) and c not in unknown] for k, v in classes.items()}
        self._low = re.compile(PATTERN.format(**{k: _ranges(v) for k, v in low.items()}))
        self._high = re.compile(f"[^\\x00-\\U{LOW - 1:08x}]")
        self._plain = regex.compile(PATTERN.format(**classes))
        self._unknown = self._exact = None
        if unknown:
            self._unknown = regex.compile(f"[{_ranges(unknown)}]")
            exact = PATTERN.replace("[^{S}{L}{N}]", "(?:{O})").replace("[{L}]", "{L}").replace("[{N}]", "{N}")
            older = {k: f"(?!{self._unknown.pattern}){classes[k]}" for k in "LN"}
            other = rf"[^\s\p{{L}}\p{{N}}]|{self._unknown.pattern}"
            self._exact = regex.compile(exact.format(S=r"\s", L=f"(?:{older['L']})", N=f"(?:{older['N']})", O=other))

    def __call__(self, text: str) -> list[str]:
        if not self._high.search(text):
            return self._low.findall(text)
        if self._unknown is not None and self._unknown.search(text):
            return self._exact.findall(text)
        return self._plain.findall(text)


class _Places(dict):
    """Word to place in the table; a word met for the first time gets the next place."""

    def __init__(self, known: dict):
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        return place


def _spelling(token: str, alphabet: dict[str, int]) -> bytes:
    if all(c in alphabet for c in token):
        return bytes(alphabet[c] for c in token)
    return token.encode()


def _first_of(owner: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))


def merge_words(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and where each word's ids start (one entry more)."""
    sizes = np.array([len(w) for w in words], np.int64)
    symbol = vocabulary.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), sizes)
    place, rank = _look_up(symbol, owner, np.arange(len(symbol)), vocabulary)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbol):
        firsts = _first_of(owner)
        lowest = np.minimum.reduceat(rank, firsts)
        counts = np.diff(np.append(firsts, len(owner)))
        lowest = np.repeat(lowest, counts)
        finished = lowest == _NONE
        if finished.any():
            done.append((owner[finished], symbol[finished]))
            left = ~finished
            symbol, owner, place, rank, lowest = symbol[left], owner[left], place[left], rank[left], lowest[left]
            if not len(symbol):
                break
        chosen = rank == lowest
        # In a run of one symbol pairs overlap: every other one merges, from the left.
        index = np.arange(len(chosen))
        run_start = np.maximum.accumulate(np.where(chosen, 0, index + 1))
        chosen &= (index - run_start) % 2 == 0
        at = np.flatnonzero(chosen)
        symbol[at] = vocabulary.merged[place[at]]
        kept = np.ones(len(symbol), bool)
        kept[at + 1] = False
        moved = at - np.arange(len(at))  # one symbol fewer for each merge further left
        symbol, owner, place, rank = symbol[kept], owner[kept], place[kept], rank[kept]
        touched = np.concatenate([moved, moved[moved > 0] - 1])
        place[touched], rank[touched] = _look_up(symbol, owner, touched, vocabulary)
    owners = np.concatenate([o for o, _ in done]) if done else np.zeros(0, np.int64)
    flat = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int64)
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.bincount(owners, minlength=len(words)), out=starts[1:])
    return flat[np.argsort(owners, kind="stable")].astype(np.uint32), starts


def _look_up(symbol: np.ndarray, owner: np.ndarray, at: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Place among the pair keys, and rank, of the pairs that begin at ``at``."""
    after = np.minimum(at + 1, len(symbol) - 1) if len(symbol) else at
    wanted = (symbol[at] << 32) | symbol[after]
    place = np.minimum(np.searchsorted(v.keys, wanted), max(len(v.keys) - 1, 0))
    if not len(v.keys):
        return place, np.full(len(at), _NONE)
    found = (v.keys[place] == wanted) & (owner[at] == owner[after]) & (after > at)
    return place, np.where(found, v.ranks[place], _NONE)


class Coder:
    """Encodes and decodes texts; remembers a bounded number of words."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self._vocabulary, self._remembered = vocabulary, remembered
        self._words = Cutter(vocabulary.unknown)
        names = sorted(vocabulary.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self._forget()

    def _forget(self) -> None:
        # Words are known by text; special tokens by their id, which no text equals.
        self._places = _Places({i: k for k, i in enumerate(self._vocabulary.special.values())})
        self._ids = np.array(list(self._places), np.uint32)
        self._starts = np.arange(len(self._places) + 1)

    def _cut(self, text: str) -> list[str | int]:
        if self._special is None or not any(name in text for name in self._vocabulary.special):
            return self._words(text)
        out: list[str | int] = []
        for k, part in enumerate(self._special.split(text)):
            out.extend([self._vocabulary.special[part]] if k % 2 else self._words(part))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of each text."""
        out: list[np.ndarray] = []
        for some in textbytes.slices(texts, _SLICE):
            if len(self._places) > self._remembered:
                self._forget()
            cut = [self._cut(t) for t in texts[some]]
            found = [np.fromiter(map(self._places.__getitem__, words), np.int64, len(words)) for words in cut]
            if self._places.new:
                ids, starts = merge_words([w.encode() for w in self._places.new], self._vocabulary)
                self._starts = np.concatenate([self._starts, starts[1:] + len(self._ids)])
                self._ids = np.concatenate([self._ids, ids])
                self._places.new = []
            out.extend(_gather(self._ids, self._starts, places) for places in found)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; those outside the vocabulary say nothing, broken UTF-8 becomes U+FFFD."""
        v = self._vocabulary
        ids = ids[ids < len(v.token_starts) - 1].astype(np.int64)
        return _gather(v.token_bytes, v.token_starts, ids).tobytes().decode("utf-8", "replace")


def _gather(flat: np.ndarray, starts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The stretches ``which`` of ``flat``, one after the other."""
    sizes = starts[which + 1] - starts[which]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts[which] - (ends - sizes), sizes)]


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose values of ``column`` have about a megabyte together."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    share = np.cumsum(sizes) // _SLICE
    cuts = [0, *(np.flatnonzero(np.diff(share)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _binary(ids: list[np.ndarray]) -> pa.Array:
    """Little-endian 32-bit ids of each text as one binary column."""
    flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype("<u4")
    ends = np.concatenate([[0], np.cumsum([4 * len(i) for i in ids])]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def _mapped(table: DataFrame, column: str, path: str | None, schema: str, convert) -> DataFrame:
    """``doc_id`` and what ``convert`` makes of ``column``, a part of a batch at a time."""
    spark = table.sparkSession
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    workers.ready(spark)
    held = spark.sparkContext.broadcast(read_vocabulary(path))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(held.value)
        for batch in batches:
            for part in _parts(batch, column):
                out = convert(coder, part.column(column).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *out.values()], ["doc_id", *out])

    plain = table.select(F.col("doc_id").cast("long").alias("doc_id"), column)
    return plain.mapInArrow(mapped, f"doc_id long, {schema}")


def _encoded(coder: Coder, texts: list[str | None]) -> list[np.ndarray]:
    return coder.encode([t or "" for t in texts])


def _decoded(coder: Coder, ids: Iterable[np.ndarray]) -> pa.Array:
    return pa.array([coder.decode(i) for i in ids], pa.string())


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` of every text: unsigned 32-bit integers, little-endian, as binary.

    Null and empty texts have no ids. Texts of any length are encoded whole; a stretch without
    any place to cut it is one word and takes as many rounds as it has different merges.
    """
    return _mapped(docs, "text", path, "ids binary", lambda coder, texts: {"ids": _binary(_encoded(coder, texts))})


def decode(coded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id`` and ``text`` of every row's ``ids``, as ``encode`` gives them. Null ids give an empty text."""

    def texts(coder: Coder, ids: list[bytes | None]) -> dict[str, pa.Array]:
        return {"text": _decoded(coder, (np.frombuffer(i or b"", "<u4") for i in ids))}

    return _mapped(coded, "ids", path, "text string", texts)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``doc_id``, ``ids`` and ``decoded`` text of every row.

    Null text counts as empty; repeated rows and null ids are rows like others; an empty table
    gives an empty result; further columns of ``docs`` are not read.
    """

    def both(coder: Coder, texts: list[str | None]) -> dict[str, pa.Array]:
        ids = _encoded(coder, texts)
        return {"ids": _binary(ids), "decoded": _decoded(coder, ids)}

    return _mapped(docs, "text", path, "ids binary, decoded string", both)


def digests(coded: DataFrame) -> DataFrame:
    """Number of ids and hashes of ids and decoded text, from ``round_trip``."""
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
