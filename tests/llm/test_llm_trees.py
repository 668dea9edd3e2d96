"""Prefix trie, importance resampling and BPE against plainly written versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).parent))

import corpus  # noqa: E402
from excursio.llm import bpe, prefixtree, resample  # noqa: E402

TURNS = "conv_id long, turn long, role string, text string"


def plain_trie(rows: list[tuple]) -> dict[tuple, tuple]:
    original = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            original[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in original.items()}
    members = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        turns = own.get(c - c % 100, [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append((c, len(turns) == d))
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for prefix, found in members.items():
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] += prefix not in kids
            saved[prefix[:d]] += (len(found) - 1) * len(prefix[-1][1]) if prefix else 0
    return {
        (found[0][0], len(p)): (
            members[p[:-1]][0][0] if p else None,
            len(found),
            kids[p],
            leaves[p],
            saved[p],
            hashlib.sha256(",".join(str(c) for c, ends in found if ends).encode()).hexdigest(),
        )
        for p, found in members.items()
    }


def trie(spark, rows, schema=TURNS):
    found = prefixtree.prefix_tree(spark.createDataFrame(rows, schema)).collect()
    out = {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in found}
    assert len(out) == len(found)
    return out


def conversations(seed: int, n: int) -> list[tuple]:
    draw, rows = random.Random(seed), []
    for c in range(n):
        words = [draw.choice("abc") for _ in range(draw.randint(1, 9))]
        rows += [(c, k, draw.choice(["user", "user", "bot"]), w * draw.randint(1, 2)) for k, w in enumerate(words)]
    return rows


def test_trie_of_random_conversations(spark):
    rows = conversations(3, 260)
    # One conversation much longer than all others, many copies of another, repeated rows and ties.
    rows += [(1000 + k, t, "user", f"turn {t}") for k in range(40) for t in range(8)]
    rows += [(2000, t, "bot", f"long {t % 7}") for t in range(700)]
    rows += [(3001, 1, "user", "x")] * 6 + [(3002, 1, "user", "b"), (3002, 1, "user", "a"), (3002, 1, "bot", "z")]
    assert trie(spark, rows) == plain_trie(rows)


def test_trie_with_nulls_negatives_and_absent_families(spark):
    rows = [
        (None, 0, "user", "no conversation"),
        (7, None, None, None),
        (7, 0, "user", None),
        (7, 1, None, "x"),
        (555, 3, "user", "alone in its family"),
        (-5, 0, "user", "é" * 5000),
        (-5, None, "user", ""),
    ]
    # The remainder keeps the sign, in Spark as in SQL.
    got = trie(spark, [r for r in rows if r[0] is None or r[0] >= 0])
    assert got == plain_trie([r for r in rows if r[0] is None or r[0] >= 0])
    assert len(trie(spark, rows)) >= len(got)


def test_trie_of_nothing_and_with_clashing_columns(spark):
    assert trie(spark, []) == {}
    rows = conversations(5, 20)
    wide = [(*r, 1, "x", 2, 3) for r in rows]
    assert trie(spark, wide, f"{TURNS}, depth long, range string, turns long, k0 long") == plain_trie(rows)


def test_subtree_totals_of_a_long_chain_take_few_rounds(spark, monkeypatch):
    n, rounds = 400, []
    step = prefixtree._round
    monkeypatch.setattr(prefixtree, "_round", lambda *a: rounds.append(1) or step(*a))
    nodes = spark.range(n).selectExpr(
        "0L AS conv_id", "id AS depth", "IF(id = 0, NULL, 0L) AS up_conv", "IF(id = 0, NULL, id - 1) AS up_depth", "id AS v"
    )
    found = {r["depth"]: r["v"] for r in prefixtree.subtree_totals(nodes, ["v"]).collect()}
    assert found == {d: sum(range(d, n)) for d in range(n)}
    assert len(rounds) <= 24  # the logarithm of 400 to the base of 1.5, and some


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_resample(docs, target, percent=10, least=20, longest=1, buckets=10_000, seed=2024):
    def features(text):
        w = words(text)
        return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    place = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(place(f) for _, text in docs for f in features(text))
    t = Counter(place(f) for text in target for f in features(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    rows = []
    for doc_id, text in docs:
        found = features(text)
        weight = sum(gain(place(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, len(words(text))])
    enough = [r for r in rows if r[5] >= least]
    enough.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    for k, r in enumerate(enough[: percent * len(enough) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def resampled(spark, docs, target, **options):
    table = spark.createDataFrame(docs, corpus.DOCUMENTS)
    wanted = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    return sorted(map(tuple, resample.resample(table, wanted, **options).collect()), key=str)


TARGET = ["The best of THE words, and more", None, "", "42 übers déjà"]


@pytest.mark.parametrize("options", [{}, {"percent": 100, "least_words": 1}, {"percent": 55, "least_words": 2, "longest": 3, "buckets": 97}])
def test_resampling_against_a_plain_version(spark, options):
    docs = [*corpus.plain(150, 30), *corpus.odd()]
    docs += [docs[3]] * 30 + [corpus.row(None, docs[4][1])] * 30
    plain = {("least" if k == "least_words" else k): v for k, v in options.items()}
    assert resampled(spark, docs, TARGET, **options) == plain_resample([d[:2] for d in docs], TARGET, **plain)


def test_resampling_in_many_segments(spark, monkeypatch):
    monkeypatch.setattr(resample, "SEGMENT", 40)
    monkeypatch.setattr(resample, "SAMPLES", 4)
    docs = [*corpus.plain(400, 25)] + [corpus.row(7, "the of and " * 8)] * 300
    options = {"percent": 70, "least_words": 1}
    got = resampled(spark, docs, TARGET, **options)
    assert got == plain_resample([d[:2] for d in docs], TARGET, percent=70, least=1)


def test_segments_stay_even_with_one_score_for_all(spark, monkeypatch):
    monkeypatch.setattr(resample, "SEGMENT", 100)
    rows = spark.range(0, 2000, 1, 5).selectExpr("1L AS doc_id", "20L AS n_features", "3L AS weight", "5L AS score")
    runs = resample._sorted_runs(rows)
    splitters = resample._splitters(runs, 2000)
    keys = [runs[k] for k in resample._KEYS]
    sizes = [r["count"] for r in runs.groupBy(resample._segment_of(splitters)(*keys)).count().collect()]
    assert sum(sizes) == 2000 and len(sizes) == 20 and max(sizes) <= 200
    assert sorted(r["rank"] for r in resample.ranked(rows, 2000).collect()) == list(range(1, 2001))


def test_resampling_of_nothing(spark):
    assert resampled(spark, [], TARGET) == []
    docs = corpus.plain(30, 25)
    assert resampled(spark, docs, []) == plain_resample([d[:2] for d in docs], [])


def test_features_of_a_long_text_read_in_parts(monkeypatch):
    monkeypatch.setattr(resample, "_CHUNK", 11)
    text = " ".join(f"w{k}" for k in range(200))
    parts = list(resample.Hasher(1000, 3).features(text))
    want = [" ".join(words(text)[i : i + n]) for n in (1, 2, 3) for i in range(200 - n + 1)]
    assert len(parts) > 5 and sum(n for n, _ in parts) == 200
    assert sorted(np.concatenate([b for _, b in parts]).tolist()) == sorted(zlib.crc32(w.encode()) % 1000 for w in want)


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    return path, Tokenizer.from_file(path)


PARTS = ["a", "aa", " ", "  ", "\n", "\t", "é", "漢字", "1", "'s", "'LL", "'ll", "<|endoftext|>", "<|endoftext", "　", "\x1c", "\x85"]
PARTS += ["😀", "ﬁ", "́", " the", "ing", "​", "٣", "Ⅷ", "²", "\x00", "\xa0", "՘", "Ᲊ", "!", "?!"]


def test_ids_equal_the_library(tokenizer):
    path, library = tokenizer
    draw, coder = random.Random(11), bpe.Coder(bpe.read_vocabulary(path), remembered=50)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 50))) for _ in range(1500)]
    texts += ["a" * 30_000, "漢字仮名" * 3000, "".join(chr(draw.randint(0x4E00, 0x9FFF)) for _ in range(3000))]
    texts += ["".join(draw.choice("abcdefgh") for _ in range(5000)), "aaab" * 999]
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text[:60]
        assert coder.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_decoding_of_ids_that_no_text_has(tokenizer):
    path, library = tokenizer
    draw, coder = random.Random(5), bpe.Coder(bpe.read_vocabulary(path))
    for _ in range(300):
        ids = [draw.randrange(50_257) for _ in range(draw.randint(0, 12))]
        assert coder.decode(np.array(ids, np.uint32)) == library.decode(ids, skip_special_tokens=False)


def test_characters_are_cut_as_the_library_cuts_them(tokenizer):
    path, library = tokenizer
    cut = bpe.Cutter(bpe.read_vocabulary(path).unknown)
    for code in [*range(0xD800), *range(0xE000, 0x110000, 7)]:
        text = f"a{chr(code)}1{chr(code)}!{chr(code)} "
        assert [len(w) for w in cut(text)] == [b - a for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)], hex(code)


def test_other_tokenizers_are_refused(tokenizer):
    import public_tokenizers

    with pytest.raises(ValueError):
        bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_round_trip_of_whole_tables(spark, tokenizer):
    _, library = tokenizer
    docs = corpus.odd() + [corpus.row(900, "a <|endoftext|> b"), corpus.row(901, "Ᲊ é́漢 1")]
    clashing = [T.StructField("ids", T.LongType()), T.StructField("decoded", T.StringType())]
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], T.StructType([*corpus.DOCUMENTS.fields, *clashing]))
    got = sorted(map(tuple, bpe.digests(bpe.round_trip(table)).collect()), key=str)
    want = []
    for doc_id, text, *_ in docs:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4")
        back = library.decode(ids.tolist(), skip_special_tokens=False)
        assert back == (text or "")
        want.append((doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    again = bpe.decode(bpe.encode(table)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in again) == sorted((d[0] or 0, d[1] or "") for d in docs)
    assert bpe.digests(bpe.round_trip(table.limit(0))).count() == 0
