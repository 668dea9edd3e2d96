from __future__ import annotations

import hashlib
import random
import re
import sys
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import corpus  # noqa: E402
from excursio.llm import chosenpath, fingerprint, impact, textbytes  # noqa: E402


def edited(text: str, seed: int, changes: int) -> str:
    draw, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
    return " ".join(words)


def brute_links(texts: list, threshold: float = 0.8) -> tuple[list[int], list[int]]:
    sets = [set(s.tolist()) for s in textbytes.shingles(texts)]
    n = len(texts)
    links, label = [0] * n, list(range(n))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or (a & b and len(a & b) / len(a | b) >= threshold - 1e-9):
                links[i] += 1
                links[j] += 1
                label[max(root(i), root(j))] = min(root(i), root(j))
    return links, [root(i) for i in range(n)]


def check_against_brute(spark, rows):
    docs = corpus.frame(spark, rows).withColumn("class_id", F.lit("clash")).withColumn("row", F.lit("clash"))
    found = chosenpath.near_duplicates(docs).collect()
    links, label = brute_links([r[1] for r in rows])
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["links"]) for r in found) == sorted(
        (r[0] is None, r[0] or 0, r[1] or "", n) for r, n in zip(rows, links)
    )
    ids = {}
    for r, k in zip(rows, label):
        ids.setdefault(k, []).append(r[0])
    classes = Counter(min((x for x in ids[k] if x is not None), default=None) for k in label)
    assert Counter(r["class_id"] for r in found) == classes
    assert sum(r["kept"] for r in found) == len(ids)
    assert {r["doc_id"] for r in found if r["kept"]} == {r["class_id"] for r in found}


def test_join_equals_brute_force(spark):
    rows = corpus.plain(40, 80) + corpus.odd()
    base = corpus.sentence("en", 200, 500)
    rows += [corpus.row(2000 + k, edited(base, k, k % 6)) for k in range(40)]
    check_against_brute(spark, rows)


def test_join_in_large_buckets_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(chosenpath, "SMALL", 4)
    monkeypatch.setattr(chosenpath, "BLOCK", 8)
    base = corpus.sentence("en", 150, 501)
    line = corpus.sentence("en", 20, 502)
    rows = [corpus.row(3000 + k, edited(base, k, k % 5)) for k in range(60)]
    rows += [corpus.row(4000 + k, line + " " + corpus.sentence("de", 10 + k, 700 + k)) for k in range(80)]
    check_against_brute(spark, rows)


def test_recall_at_the_threshold():
    """Pairs just at the threshold meet in some run."""
    draw = np.random.default_rng(3)
    missed = 0
    for _ in range(300):
        shared, own = draw.integers(0, 2**63, 80, dtype=np.uint64), draw.integers(0, 2**63, 20, dtype=np.uint64)
        sets = [np.sort(np.r_[shared, own[:10]]), np.sort(np.r_[shared, own[10:]])]
        a, b = chosenpath._chosen(sets, chosenpath.RATE, 0, chosenpath.RUNS, 0.8)
        missed += not set(a.tolist()) & set(b.tolist())
    assert missed == 0


def test_recall_in_a_large_group(spark):
    """In a group of 400 whose sets are at 0.8 or just above no link is lost: its buckets are compared completely."""
    base = [f"w{k}" for k in range(270)]
    rows = []
    for k in range(400):
        words, at = list(base), 20 + (k * 7) % 230
        words[at : at + 4] = [f"own{k}a", f"own{k}b"]
        if k % 3 == 0:
            words[5:8] = [f"own{k}c"]
        rows.append(corpus.row(k, " ".join(words)))
    check_against_brute(spark, rows)


def test_recall_below_the_first_level(spark):
    """Pairs just above 0.8 that share a passage with 1,500 others meet below the first level: 0.999 of them at least."""
    passage = [f"p{k}" for k in range(160)]
    rows = []
    for k in range(750):
        own = [f"k{k}x{j}" for j in range(40)]
        other = own[:12] + [f"k{k}y{j}" for j in range(17)] + own[29 + k % 2 :]
        rows += [corpus.row(2 * k, " ".join(passage + own)), corpus.row(2 * k + 1, " ".join(passage + other))]
    docs = corpus.frame(spark, rows)
    sets = textbytes.shingles([r[1] for r in rows], 5)
    alike = [len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for a, b in zip(sets[::2], sets[1::2])]
    assert 0.8 <= min(alike) and max(alike) < 0.81
    found = {r["doc_id"]: (r["class_id"], r["links"]) for r in chosenpath.near_duplicates(docs).collect()}
    met = sum(found[2 * k] == found[2 * k + 1] == (2 * k, 1) for k in range(750))
    assert met >= 749


def test_groups_about_centres_equal_brute_force(spark, monkeypatch):
    """Near, middling and far copies of two texts that share a half, and texts that only hold a half: all links, by centre or bucket."""
    monkeypatch.setattr(chosenpath, "SMALL", 4)
    monkeypatch.setattr(chosenpath, "BLOCK", 8)
    base = corpus.sentence("en", 150, 510)
    half = " ".join(base.split()[:75])
    second = half + " " + corpus.sentence("de", 75, 511)
    rows = [corpus.row(5000 + k, edited(base, k, k % 16)) for k in range(90)]
    rows += [corpus.row(6000 + k, edited(second, k, k % 7)) for k in range(20)]
    rows += [corpus.row(7000 + k, half + " " + corpus.sentence("fr", 40 + 9 * (k % 9), 800 + k)) for k in range(15)]
    rows += [corpus.row(8000 + k, edited(rows[15][1], 99 + k, k % 4)) for k in range(12)]
    kinds, parted = Counter(), chosenpath._parted

    def seen(*args):
        found = parted(*args)
        kinds.update({r["kind"]: r["count"] for r in found.groupBy("kind").count().collect()})
        return found

    monkeypatch.setattr(chosenpath, "_parted", seen)
    check_against_brute(spark, rows)
    assert all(kinds[k] for k in range(3)), kinds


def test_rows_compared_follow_the_size_of_a_group(spark, monkeypatch):
    """Near copies with an edit each, two apart: rows that go to comparison don't grow with the square of their number."""
    frames = type(corpus.frame(spark, []))
    compared, plain = [], frames.mapInPandas

    def seen(self, func, schema, *args, **options):
        if str(schema).startswith("rep long, part long"):
            compared.append(self.count())
        return plain(self, func, schema, *args, **options)

    monkeypatch.setattr(frames, "mapInPandas", seen)
    monkeypatch.setattr(chosenpath, "BLOCK", 16)
    base, made = corpus.sentence("en", 300, 520), []
    for n in (150, 600):
        compared.clear()
        docs = corpus.frame(spark, [corpus.row(k, edited(base, k, 1 + k % 2)) for k in range(n)])
        assert {(r["class_id"], r["links"]) for r in chosenpath.near_duplicates(docs).collect()} == {(0, n - 1)}
        assert compared
        made.append(sum(compared))
    assert made[1] <= max(8 * made[0], 4 * 600), made


def test_rates_bring_the_chance_of_a_miss_down():
    missed, held = np.array([1.0, 0.145, 2.7e-4]), np.array([15, 10, 5])
    rates = chosenpath._deep_rates(missed, held, 0.8)
    found = 1 - np.exp(-rates * (1 - np.exp(-rates)))
    assert (rates < chosenpath.DEEP_RATE).all()
    assert (missed * (1 - 0.64 * found) ** held <= chosenpath.MISS).all()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(100)] + [(500, 400)], "a long, b long")
    labels = {r["node"]: r["label"] for r in chosenpath.components(edges).collect()}
    assert labels == {**{k: 0 for k in range(101)}, 400: 400, 500: 400}


def test_join_of_an_empty_table(spark):
    assert chosenpath.near_duplicates(corpus.frame(spark, [])).count() == 0
    assert chosenpath.kept_documents(corpus.frame(spark, [])).columns == corpus.DOCUMENTS.names


def jaccard(a: str, b: str) -> float:
    x, y = (Counter(w for w in re.split(r"[\x09-\x0d\x20]+", t) if w) for t in (a, b))
    return sum((x & y).values()) / total if (total := sum((x | y).values())) else 1.0


def test_fingerprints_estimate_generalised_jaccard(spark):
    rows = sorted(corpus.plain(150, 90), key=lambda r: r[0])
    docs = corpus.frame(spark, rows).withColumn("fingerprint", F.lit("clash"))
    found = {r["doc_id"]: r for r in fingerprint.edited_fingerprints(docs).collect()}
    assert len(found) == len(rows)
    gaps = []
    for k, (doc_id, text, *_) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        r = found[doc_id]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        gaps += [r["near_edited"] - jaccard(text, new), r["near_next"] - jaccard(text, after)]
    assert abs(np.mean(gaps)) < 0.02 and np.std(gaps) < 0.12


def test_collision_rate_with_weights(spark):
    pairs = [("a " * 9 + "b " * 3 + "c", "a " * 5 + "b " * 6 + "d"), ("x y z", "x y z"), ("p q", "r s")]
    texts = spark.createDataFrame([(k, side, t) for k, p in enumerate(pairs) for side, t in enumerate(p)], "k int, side int, text string")
    signatures = {(r["k"], r["side"]): r["signature"] for r in fingerprint.fingerprints(texts, ["k", "side"], samples=400).collect()}
    for k, (a, b) in enumerate(pairs):
        rate = np.mean([x == y for x, y in zip(signatures[k, 0], signatures[k, 1])])
        assert abs(rate - jaccard(a, b)) < 0.08


def test_fingerprints_of_odd_rows(spark):
    rows = corpus.odd()
    found = fingerprint.edited_fingerprints(corpus.frame(spark, rows)).collect()
    assert sorted(r["n_chars"] for r in found) == sorted(len(r[1] or "") for r in rows)
    same = [r["fingerprint"] for r in found if r["n_chars"] == len("same text here twice again and again")]
    assert len(same) >= 3 and len(set(same)) <= 2
    assert {r["fingerprint"] for r in found if r["doc_id"] in (1000, 1001, 1002)} == {"f" * 8 * fingerprint.SAMPLES}
    one = fingerprint.edited_fingerprints(corpus.frame(spark, [corpus.row(5, "one two three")])).first()
    assert one["near_next"] == 1.0
    assert fingerprint.edited_fingerprints(corpus.frame(spark, [])).count() == 0


def test_every_row_finds_its_successor_over_ranges(spark):
    docs = spark.createDataFrame([(k * 3, f"t{k}") for k in range(97)], "doc_id long, text string")
    ranged = fingerprint.in_ranges(docs, rows_per_range=10)
    assert ranged.where("not _guest").count() == 97 and ranged.where("_guest").count() == ranged.select("_range").distinct().count()


def brute_top(vectors: dict, k: int = 5) -> set:
    out = set()
    for q, v in vectors.items():
        if q % 50 == 0:
            scored = sorted((-int(np.dot(v, w)), c) for c, w in vectors.items() if c != q)[:k]
            out |= {(q, rank, c, -s) for rank, (s, c) in enumerate(scored, 1)}
    return out


def test_search_equals_brute_force_with_ties(spark):
    draw = np.random.default_rng(4)
    vectors = {k: draw.normal(0, 0.3, 16) for k in range(230)}
    for k in range(40, 90):
        vectors[k] = vectors[3]
    rows = [(k, [float(np.float32(x)) for x in v], "clash") for k, v in vectors.items()]
    rows += [(300, None, ""), (350, [1.0, None], ""), (400, [float("nan")] * 16, ""), (450, [float("inf")] * 16, ""), (None, [0.1] * 16, "")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    whole = {k: np.floor(256 * np.array([float(np.float32(x)) for x in v])).astype(np.int64) for k, v in vectors.items()}
    for sizes in ({}, {"candidates_per_block": 20, "queries_per_block": 2}):
        found = impact.best_matches(table, F.col("vec_id") % 50 == 0, **sizes).collect()
        assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found} == brute_top(whole)
        assert len(found) == 5 * 5


def test_search_stops_by_proof_with_the_same_result():
    draw = np.random.default_rng(5)
    vectors = np.rint(draw.normal(0, 3, (400, 12)) ** 3).astype(np.int64)
    ids = draw.permutation(400)
    for found in impact.search_block(ids, vectors, ids[:20], vectors[:20], 5):
        query, got, scores = found
        exact = vectors @ vectors[list(ids).index(query)]
        best = sorted((-int(s), int(i)) for s, i in zip(exact, ids) if i != query)[:5]
        assert [(-int(s), int(i)) for s, i in zip(scores, got)] == best


def test_search_of_few_zero_and_huge_vectors(spark):
    query = F.col("vec_id") % 50 == 0
    schema = "vec_id long, embedding array<double>"
    assert impact.best_matches(spark.createDataFrame([], schema), query).count() == 0
    assert impact.best_matches(spark.createDataFrame([(0, [1.0])], schema), query).count() == 0
    zeros = spark.createDataFrame([(k, [0.0, 0.0]) for k in range(8)], schema)
    assert [r["vec_id"] for r in impact.best_matches(zeros, query).orderBy("rank").collect()] == [1, 2, 3, 4, 5]
    huge = spark.createDataFrame([(0, [3e5, 1.0]), (1, [3e5, 1.0]), (2, [3e5, 2.0])], schema)
    top = impact.best_matches(huge, query).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in top] == [(2, 76800000**2 + 256 * 512), (1, 76800000**2 + 256 * 256)]


def test_rows_that_share_an_id_are_searched_one_by_one(spark):
    rng = np.random.default_rng(11)
    rows = [(int(n), [float(x) for x in rng.normal(size=6)]) for n in rng.integers(0, 120, 400)]
    rows += [rows[0]] * 3 + [(50, [0.5, 0.5]), (50, [0.9, 0.9]), (1, None)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    duck = duckdb.connect()
    duck.register("raw", table.toPandas())
    duck.execute("CREATE TABLE embeddings AS SELECT vec_id, embedding::DOUBLE[] AS embedding FROM raw")
    short = "list_resize([CAST(floor"  # the statement takes vectors of one length
    sql = impact.SQL.replace("[CAST(floor", short).replace("FOR x IN embedding] AS v", "FOR x IN embedding], 6, 0) AS v")
    wanted = sorted(duck.sql(sql).fetchall())
    for sizes in ({}, {"candidates_per_block": 90, "queries_per_block": 3}):
        found = impact.best_matches(table, F.col("vec_id") % 50 == 0, **sizes)
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(tuple(r) for r in found.collect()) == wanted


def test_huge_scores_stay_exact(spark):
    big = 2**29
    rows = [(0, [float(big // 256), 1 / 256])] + [(n, [float(big // 256), n / 256]) for n in range(1, 40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = impact.best_matches(table, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(n, big * big + n) for n in (39, 38, 37, 36, 35)]
