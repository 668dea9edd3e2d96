"""Token counts that follow edits.

A document's text is cut into leaves of about ``LEAF`` characters at places where no pre-token can
reach across: before a single space that stands between two characters that aren't white space.
Encoding the leaves one by one gives as many tokens as encoding the whole. A segment tree keeps
the sums of characters and tokens of every run of leaves.

An edit re-encodes the leaves it touches and, as far as the edit made their borders unsafe, their
neighbours. Their sums are renewed from the leaf to the root; the rest of the document isn't read.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from excursio.llm import packing, workers

LEAF = 512
#: A leaf that edits have made longer than this is cut up again, with the whole tree.
LONGEST = 16 * LEAF


def _safe(before: str, after: str) -> bool:
    """Whether tokens of ``before`` and ``after`` are those of both together."""
    return len(after) > 1 and after[0] == " " and not after[1].isspace() and before != "" and not before[-1].isspace()


def _cut(text: str, leaf: int) -> list[str]:
    out, begin = [], 0
    while len(text) - begin > leaf:
        at = begin + leaf
        while True:
            at = text.find(" ", at)
            if at < 0 or at + 1 >= len(text):
                at = len(text)
                break
            if not text[at + 1].isspace() and not text[at - 1].isspace():
                break
            at += 1
        out.append(text[begin:at])
        begin = at
    if begin < len(text) or not out:
        out.append(text[begin:])
    return out


class TokenTree:
    """Characters and tokens of a text by segments; ``count`` counts the tokens of a string."""

    def __init__(self, text: str, count, leaf: int = LEAF):
        self._count, self._leaf = count, leaf
        self.encoded = 0
        self._build(_cut(text, leaf))

    def _build(self, leaves: list[str]) -> None:
        self._size = 1 << max(len(leaves) - 1, 0).bit_length()
        self.texts = leaves + [""] * (self._size - len(leaves))
        self._chars, self._tokens = [0] * (2 * self._size), [0] * (2 * self._size)
        for k, text in enumerate(leaves):
            self._chars[self._size + k] = len(text)
            self._tokens[self._size + k] = self._encode(text)
        for k in range(self._size - 1, 0, -1):
            self._chars[k] = self._chars[2 * k] + self._chars[2 * k + 1]
            self._tokens[k] = self._tokens[2 * k] + self._tokens[2 * k + 1]

    def _encode(self, text: str) -> int:
        self.encoded += len(text)
        return self._count(text) if text else 0

    @property
    def tokens(self) -> int:
        return self._tokens[1]

    @property
    def chars(self) -> int:
        return self._chars[1]

    def text(self) -> str:
        return "".join(self.texts)

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last with text, if there is none), and where it begins."""
        node, begin = 1, 0
        at = min(at, max(self._chars[1] - 1, 0))
        while node < self._size:
            node *= 2
            if at - begin >= self._chars[node]:
                begin += self._chars[node]
                node += 1
        return node - self._size, begin

    def _set(self, leaf: int, text: str) -> None:
        self.texts[leaf] = text
        node = self._size + leaf
        self._chars[node], self._tokens[node] = len(text), self._encode(text)
        while node > 1:
            node //= 2
            self._chars[node] = self._chars[2 * node] + self._chars[2 * node + 1]
            self._tokens[node] = self._tokens[2 * node] + self._tokens[2 * node + 1]

    def edit(self, at: int, removed: int, inserted: str) -> None:
        """Replace ``removed`` characters from ``at`` on; both are cut to the text's bounds."""
        at = min(max(at, 0), self.chars)
        removed = min(max(removed, 0), self.chars - at)
        if not removed and not inserted:
            return
        first, begin = self._find(at)
        last, end = self._find(at + removed - 1) if removed else (first, begin)
        end += len(self.texts[last])
        region = "".join(self.texts[first : last + 1])
        region = region[: at - begin] + inserted + region[at - begin + removed :]
        # Whether a border is safe depends on one character before it and two after.
        while begin > 0:
            before, start = self._find(begin - 1)
            if _safe(self.texts[before], region if len(region) > 1 else region + self._after(end)):
                break
            region, first, begin = self.texts[before] + region, before, start
        while end < self.chars:
            after, _ = self._find(end)
            if region and _safe(region, self.texts[after] if len(self.texts[after]) > 1 else self.texts[after] + self._after(end + 1)):
                break
            region, last, end = region + self.texts[after], after, end + len(self.texts[after])
        if len(region) > max(LONGEST, 2 * self._leaf):
            leaves = [t for t in [*self.texts[:first], *_cut(region, self._leaf), *self.texts[last + 1 :]] if t]
            self._rebuild(first, last, region, leaves)
            return
        for leaf in range(first + 1, last + 1):
            if self.texts[leaf]:
                self._set(leaf, "")
        self._set(first, region)

    def _after(self, at: int) -> str:
        return self.texts[self._find(at)[0]][:2] if at < self.chars else ""

    def _rebuild(self, first: int, last: int, region: str, leaves: list[str]) -> None:
        """A new tree over the leaves; only the cut-up region is encoded again."""
        known = {}
        for k, text in enumerate(self.texts):
            if text and not first <= k <= last:
                known[text] = self._tokens[self._size + k]
        count = self._count
        self._count = lambda text: known[text] if text in known else count(text)
        encoded = self.encoded
        self._build(leaves)
        self.encoded = encoded + len(region)
        self._count = count


_COUNTS = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("edited_tokens", T.LongType()),
        T.StructField("edited_chars", T.LongType()),
        T.StructField("encoded_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
    ]
)


def count_edited(docs: DataFrame, edits: Column, files: tuple | None = None, into: str = "counts") -> DataFrame:
    """Add a struct ``into`` with the tokens of ``text`` before and after ``edits``.

    ``edits`` is an array of structs (``at``, ``removed``, ``inserted``), applied one after the other
    to the text as the edits before left it: from character ``at`` on, ``removed`` characters are replaced
    by ``inserted``. Null fields count as 0 and empty; places beyond the text mean its end.

    ``n_tokens``, ``edited_tokens``; ``edited_chars``, the length afterwards; ``encoded_chars``, how
    many characters were encoded again for the edits; ``edited_sha256`` of the edited text. Null text
    is empty, a null array no edits. Each row is counted by itself, repeated rows too; other
    columns are passed on, one named ``into`` is replaced.
    """
    workers.ready(docs.sparkSession)
    files = files or packing.public_files()

    @F.pandas_udf(_COUNTS)
    def counted(text: pd.Series, changes: pd.Series) -> pd.DataFrame:
        coder = packing.encoder(*files)

        def count(part: str) -> int:
            return len(coder.encode(part))

        rows = []
        for body, steps in zip(text.tolist(), changes.tolist()):
            tree = TokenTree(body if isinstance(body, str) else "", count)
            before, tree.encoded = tree.tokens, 0
            for step in steps if steps is not None else ():
                if step is not None:
                    tree.edit(_number(step["at"]), _number(step["removed"]), step["inserted"] or "")
            digest = hashlib.sha256(tree.text().encode("utf-8", "replace")).hexdigest()
            rows.append((before, tree.tokens, tree.chars, tree.encoded, digest))
        return pd.DataFrame(rows, columns=_COUNTS.names)

    return docs.withColumn(into, counted("text", edits))


def _number(x) -> int:
    return 0 if x is None or x != x else int(x)


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """Add the column ``edits`` from rows (``doc_id``, ``seq``, ``at``, ``removed``, ``inserted``).

    A document's edits are one array in order of ``seq`` (ties: by place, then length, then text). A null
    ``doc_id`` has no edits.
    """
    steps = F.sort_array(F.collect_list(F.struct("seq", "at", "removed", "inserted")))
    own = edits.where("doc_id IS NOT NULL").groupBy("doc_id").agg(steps.alias("edits"))
    return docs.drop("edits").join(own, "doc_id", "left")


def drawn_edits(text: Column, doc_id: Column, count: int = 4) -> Column:
    """``count`` edits drawn from a hash of the id: a run of the text's characters moves elsewhere.

    The first two edits take characters out and put others in, then one only puts in and one only takes out.
    """
    body = F.coalesce(text, F.lit(""))
    size = F.char_length(body)
    steps = []
    for k in range(count):
        draw = [F.pmod(F.xxhash64(F.coalesce(doc_id, F.lit(-1)), F.lit(10 * k + j)), F.greatest(size, F.lit(1))).cast("int") for j in (0, 1)]
        length = F.pmod(F.xxhash64(F.coalesce(doc_id, F.lit(-1)), F.lit(10 * k + 2)), F.lit(40)).cast("int")
        removed = F.lit(0) if k % 4 == 2 else length
        inserted = F.lit("") if k % 4 == 3 else F.substring(body, draw[1] + 1, length + 5)
        steps.append(F.struct(draw[0].alias("at"), removed.alias("removed"), inserted.alias("inserted")))
    return F.array(*steps)
