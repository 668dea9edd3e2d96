"""Array views of text batches: bytes, words and word shingles of many texts at once."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RANDOM = np.random.Generator(np.random.PCG64(7))
_BYTE_CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_BLOCK = 1 << 16
_ORDERS = [np.uint64(int(x) | 1) for x in _RANDOM.integers(1, 2**63, 16, dtype=np.uint64)]


def joined(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and where each text starts (one entry more)."""
    parts = [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in texts]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=starts[1:])
    return np.frombuffer(b"".join(parts), np.uint8), starts


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64((seed * 0xD1B54A32D192ED03 + 0x2545F4914F6CDD1D) % 2**64)) * np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(29)
    return x


def _powers(base: int, count: int) -> np.ndarray:
    out = np.empty(max(count, 1), np.uint64)
    out[0] = 1
    done = 1
    with np.errstate(over="ignore"):
        while done < count:
            more = min(done, count - done)
            out[done : done + more] = out[:more] * np.uint64(pow(base, done, 2**64))
            done += more
    return out


_UP, _DOWN = _powers(_BASE, _BLOCK), _powers(_BASE_INVERSE, _BLOCK)


def word_spans(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every run of non-space bytes, and the text it belongs to.

    Words never reach over the end of a text.
    """
    word = ~_SPACE[raw]
    before = np.zeros(len(raw), bool)
    before[1:] = word[:-1]
    inner = starts[1:-1]
    inner = inner[inner < len(raw)]
    before[inner] = False
    begins = np.flatnonzero(word & ~before)
    after = np.zeros(len(raw), bool)
    after[:-1] = word[1:]
    after[inner[inner > 0] - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    owner = np.searchsorted(starts, begins, "right") - 1
    return begins, ends, owner


def word_hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over random byte codes, then mixed."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    with np.errstate(over="ignore"):
        step = np.uint64(pow(_BASE, _BLOCK, 2**64))
        lift = np.uint64(1)
        for at in range(0, len(raw), _BLOCK):
            part = _BYTE_CODES[raw[at : at + _BLOCK]] * _UP[: len(raw[at : at + _BLOCK])] * lift
            sums[at + 1 : at + 1 + len(part)] = part
            lift = lift * step
        np.cumsum(sums, out=sums)
        back = np.uint64(pow(_BASE_INVERSE, _BLOCK, 2**64))
        lifts = np.ones(len(raw) // _BLOCK + 1, np.uint64)
        for k in range(1, len(lifts)):
            lifts[k] = lifts[k - 1] * back
        low = (sums[ends] - sums[begins]) * _DOWN[begins % _BLOCK] * lifts[begins // _BLOCK]
    return mixed(low, 1)


def shingles(texts: Iterable[str | None], width: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width`` words.

    A text with fewer words (but at least one) has one hash, that of all its words. A null or
    wordless text has none.
    """
    raw, starts = joined(texts)
    begins, ends, owner = word_spans(raw, starts)
    words = word_hashes(raw, begins, ends)
    firsts = np.searchsorted(owner, np.arange(len(starts)))
    with np.errstate(over="ignore"):
        runs = np.zeros(max(len(words) - width + 1, 0), np.uint64)
        for k in range(width):
            runs += words[k : k + len(runs)] * _ORDERS[k]
        runs = mixed(runs, 2)
    out = []
    for i in range(len(starts) - 1):
        a, b = firsts[i], firsts[i + 1]
        if b - a >= width:
            out.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            with np.errstate(over="ignore"):
                whole = np.sum(words[a:b] * np.array(_ORDERS[: b - a], np.uint64), dtype=np.uint64)
            out.append(mixed(np.array([whole], np.uint64), 3 + int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def slices(texts: list, limit: int = 1 << 19) -> Iterable[slice]:
    """Runs of texts of about ``limit`` characters together, so that arrays over them stay small."""
    begin, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text) if isinstance(text, str) else 0
        if size >= limit:
            yield slice(begin, k + 1)
            begin, size = k + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))
