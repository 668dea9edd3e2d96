from __future__ import annotations

import math
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

import corpus  # noqa: E402
from excursio.llm import langid, quality, textbytes  # noqa: E402


def test_shingles_are_sets_of_word_runs():
    texts = ["a b c d e f", "a  b\nc d e f", "a b", "", None, "a b c d e a b c d e a b c d e", "b a"]
    sets = textbytes.shingles(texts)
    assert [len(s) for s in sets] == [2, 2, 1, 0, 0, 5, 1]
    assert (sets[0] == sets[1]).all() and sets[2][0] != sets[6][0]
    alone = [textbytes.shingles([t])[0] for t in texts]
    assert all((a == b).all() for a, b in zip(sets, alone))


def test_word_hashes_do_not_depend_on_place():
    raw, starts = textbytes.joined(["word " * 30_000, "word"])
    begins, ends, owner = textbytes.word_spans(raw, starts)
    assert len(begins) == 30_001 and owner[-1] == 1
    assert len(np.unique(textbytes.word_hashes(raw, begins, ends))) == 1


def brute_code_length(model, text: str, lang: str) -> float:
    """Code length by walking the contexts of one text symbol by symbol."""
    k = model.languages.index(lang)
    seen = defaultdict(Counter)
    for gram, owner, n in zip(model.grams, model.owners, model.counts):
        if owner == k:
            symbols = [(int(gram) >> (8 * j)) & 255 for j in range(3, -1, -1)][3 - model.order :]
            for d in range(model.order + 1):
                seen[tuple(symbols[model.order - d : -1])][symbols[-1]] += int(n)
    raw = [b if b > 127 or chr(b).isalpha() else 32 for b in (" " * model.order + text.lower()).encode()]
    total = 0.0
    for i in range(model.order, len(raw)):
        for d in range(model.order, -1, -1):
            follow = seen.get(tuple(raw[i - d : i]))
            if follow:
                n, q = sum(follow.values()), len(follow)
                if follow[raw[i]]:
                    total -= math.log2(follow[raw[i]] / (n + q))
                    break
                total -= math.log2(q / (n + q))
        else:
            total += math.log2(model.width)
    return total


def test_code_lengths_equal_a_walk_through_the_contexts(spark):
    model = langid.learn(corpus.frame(spark, corpus.plain()))
    texts = [corpus.sentence("de", 30, 99), "Xx qq ÄÖ 12", "a", "", "the " * 200]
    lengths = langid.code_lengths(model, texts) / langid.PARTS
    for text, row in zip(texts, lengths):
        for lang, bits in zip(model.languages, row):
            assert bits == pytest.approx(brute_code_length(model, text, lang), abs=0.01 + len(text) * 1e-3)


def test_two_hundred_languages_in_a_wide_alphabet_keep_order_and_memory(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(200):  # each writes with 14 letters of its own choice of a script of 300
        letters = [chr(0x400 + int(c)) for c in rng.choice(300, 14, replace=False)]
        words = ["".join(rng.choice(letters, rng.integers(3, 9))) for _ in range(60)]
        for n in range(12):
            rows.append((k * 20 + n, " ".join(rng.choice(words, 80)), f"x{k:03d}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(docs)
    assert model.order == 3 and len(model.languages) == 200
    frozen = langid.trees(model)
    assert sum(a.nbytes for language in frozen.levels for level in language for a in level) < 20 << 20
    tracemalloc.start()
    lengths = langid.tree_lengths(frozen, [r[1] for r in rows] * 2)
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
    right = np.array(model.languages)[lengths[: len(rows)].argmin(1)] == np.array([r[2] for r in rows])
    assert right.mean() > 0.99
    for place in (3, 700):
        bits = lengths[place, 17] / langid.PARTS
        assert bits == pytest.approx(brute_code_length(model, rows[place][1], "x017"), abs=0.01 + len(rows[place][1]) * 2e-3)


def test_language_of_held_out_documents_and_odd_rows(spark):
    docs = corpus.frame(spark, corpus.plain(240) + corpus.odd())
    model = langid.learn(docs)
    rows = langid.identify(docs.withColumn("score", F.lit("clash")), model).collect()
    assert len(rows) == 251
    own = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 240]
    assert sum(r["language"]["lang_pred"] == r["lang"] for r in own) >= 0.97 * len(own)
    assert all(0 <= r["language"]["score"] <= 1 and r["score"] == "clash" for r in rows)
    wordless = {r["doc_id"]: r["language"]["lang_pred"] for r in rows if r["doc_id"] in (1000, 1001, 1002, 1003)}
    assert set(wordless.values()) == {"und"}
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns
    assert {1000, 1001, 1002, 1003}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert kept.where("doc_id < 240").count() == 240


def test_language_is_learned_only_from_what_is_not_held_out(spark):
    docs = corpus.frame(spark, corpus.plain(60))
    changed = docs.withColumn("text", F.when(langid.held_out(F.col("doc_id")), F.lit("zzz")).otherwise(F.col("text")))
    a, b = langid.learn(docs), langid.learn(changed)
    assert sorted(zip(a.grams, a.owners, a.counts)) == sorted(zip(b.grams, b.owners, b.counts))


def test_language_of_empty_tables(spark):
    empty = corpus.frame(spark, [])
    assert langid.identify(empty, langid.learn(empty)).count() == 0
    untaught = langid.learn(empty)
    assert {r["language"]["lang_pred"] for r in langid.identify(corpus.frame(spark, corpus.odd()), untaught).collect()} == {"und"}


def junk(n: int) -> list[tuple]:
    makers = [
        lambda t: re.sub(r"(\w)( |$)", r"\1%%% ", t),
        lambda t: " | ".join(t.split()),
        lambda t: t.upper().replace(" ", "!! "),
        lambda t: (t.split()[0] + " ") * 80,
    ]
    return [corpus.row(5000 + k, makers[k % 4](corpus.sentence("en", 80, 600 + k))) for k in range(n)]


def test_weak_labels_find_planted_junk(spark):
    docs = corpus.frame(spark, corpus.plain(200, 80) + junk(40))
    model = quality.learn(docs)
    rows = {r["doc_id"]: r["quality"] for r in quality.judge(docs, model).collect()}
    good = [rows[k]["score"] >= quality.LEAST for k in range(200)]
    bad = [rows[5000 + k]["score"] < quality.LEAST for k in range(40)]
    assert np.mean(good) >= 0.99 and np.mean(bad) >= 0.9
    kept = quality.accepted(docs)
    assert kept.columns == docs.columns and kept.where("doc_id < 200").count() >= 198


def test_copies_do_not_shrink_the_scorers_sample(spark):
    few = corpus.frame(spark, corpus.plain(60, 80) + junk(20))
    many = few.unionByName(few.where("doc_id = 0").withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(4000)))).drop("_"))
    model = quality.learn(many, sample_rows=80)
    assert model.weights is not None and np.abs(model.weights).max() > 0
    alone = quality.learn(few, sample_rows=80)
    assert ((alone.weights != 0) == (model.weights != 0)).all()  # all 80 texts teach in both


def test_without_a_fitted_scorer_the_posterior_is_the_score(spark):
    docs = corpus.frame(spark, corpus.plain(60, 80) + junk(20))
    model = quality.learn(docs)
    model.weights = None
    rows = quality.judge(docs, model).select("quality.*").collect()
    assert all(r["score"] == r["posterior"] for r in rows) and min(r["score"] for r in rows) < quality.LEAST


def test_expectation_maximisation_recovers_accuracies():
    draw = np.random.default_rng(1)
    n, m = 60_000, 6
    truth = draw.random(n) < 0.8
    on_bad, on_good = np.linspace(0.25, 0.5, m), np.linspace(0.01, 0.05, m)
    called_bad = draw.random((n, m)) < np.where(truth[:, None], on_good, on_bad)
    patterns, counts = np.unique(1 - called_bad.astype(int), axis=0, return_counts=True)
    model = quality.expectation_maximisation(patterns, counts.astype(float))
    assert model.good == pytest.approx(0.8, abs=0.03)
    assert np.abs(model.rates[quality.BAD][:, 0] - on_bad).max() < 0.06
    assert np.abs(model.rates[quality.GOOD][:, 0] - on_good).max() < 0.02


def test_quality_of_odd_rows_and_empty_tables(spark):
    docs = corpus.frame(spark, corpus.odd())
    rows = quality.judge(docs.withColumn("votes", F.lit(1)), quality.learn(docs)).collect()
    assert len(rows) == len(corpus.odd())
    assert all(0 <= r["quality"]["score"] <= 1 and r["votes"] == 1 for r in rows)
    assert {r["quality"]["votes"] for r in rows if not (r["text"] or "").strip()} == {"2" * len(quality.LABELLERS)}
    empty = corpus.frame(spark, [])
    assert quality.judge(empty, quality.learn(empty)).count() == 0
