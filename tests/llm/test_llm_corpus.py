from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import corpus  # noqa: E402
from excursio.llm import editcount, mixing, packing, sharding, sitestyle  # noqa: E402


def words(text) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes: dict, weights=(5.0, 2.0, 1.0)) -> dict:
    """Share by weight, cut at the caps, and share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("rows_per_bucket", [2000, 5])
def test_mix_meets_every_target(spark, rows_per_bucket):
    rows = corpus.plain(120, 50) + corpus.odd() + [corpus.row(9000, "tiny", "en", "zz"), corpus.row(9001, "one two", "en", "tiny")]
    docs = corpus.frame(spark, rows).withColumn("key", F.lit("clash")).withColumn("sid", F.lit("clash"))
    found = mixing.mix(docs, rows_per_bucket=rows_per_bucket).collect()
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter((r[0], words(r[1])) for r in rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += words(r[1])
    targets = brute_targets(sizes)
    by_target = defaultdict(int)
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_target[round(r["target"], 4), r["source_size"]] += r["taken"]
    assert set(by_target) == {(round(t, 4), sizes[s]) for s, t in targets.items()}
    wanted = Counter()
    for s, t in targets.items():
        wanted[round(t, 4), sizes[s]] += round(t)
    assert all(abs(n - wanted[k]) <= 1 for k, n in by_target.items())
    assert Counter(mixing.mix(docs, rows_per_bucket=rows_per_bucket).collect()) == Counter(found)


def test_mix_prefers_plain_text(spark):
    rows = [corpus.row(k, "word " * 10 if k % 2 else "%%%% " * 10, "en", "a") for k in range(400)]
    rows += [corpus.row(1000 + k, "word " * 10, "en", "b") for k in range(4000)]
    found = mixing.mix(corpus.frame(spark, rows), weights=(1.0, 30.0)).where("doc_id < 400").collect()
    taken = [sum(r["taken"] for r in found if r["doc_id"] % 2 == odd) for odd in (0, 1)]
    assert taken[1] > 2 * taken[0] > 0


def test_mixed_documents_are_whole_rows(spark):
    rows = corpus.plain(100, 50)
    docs = corpus.frame(spark, rows)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert {tuple(r) for r in mixed.collect()} <= set(rows)
    assert mixing.mixed_documents(corpus.frame(spark, [])).count() == 0
    assert mixing.mix(corpus.frame(spark, [])).count() == 0
    assert mixing.mix(corpus.frame(spark, [corpus.row(1, None)])).first()["taken"] == 0


def test_mixed_documents_without_an_id_and_with_shared_ids(spark):
    rows = [corpus.row(None, f"null {k} " + "word " * (k % 5 + 3), "en", "a") for k in range(30)]
    rows += [corpus.row(7, f"shared {k} " + "word " * 6, "en", "a") for k in range(30)]
    rows += [corpus.row(k + 100, f"own {k} " + "word " * 6, "en", "b") for k in range(40)]
    docs = corpus.frame(spark, rows)
    mixed = mixing.mixed_documents(docs, weights=(3.0, 2.0)).collect()
    words = Counter()
    for r in mixed:
        words[r["source"]] += len(r["text"].split())
    targets = {t["source"]: t["target"] for t in mixing.targets(docs.select("source", mixing.word_count(F.col("text")).alias("size")), (3.0, 2.0)).collect()}
    assert all(abs(words[s] - targets[s]) <= 8 for s in targets)  # the one at the cut stays whole
    copies = Counter(r["text"] for r in mixed if r["doc_id"] == 7)
    wanted = mixing.mix(docs, weights=(3.0, 2.0)).where("doc_id = 7").collect()
    assert sorted(copies.values()) == sorted(n for r in wanted if (n := int(r["taken"] / r["size"] + 0.5)))
    assert any(r["doc_id"] is None for r in mixed)


def brute_shards(arrivals: list[tuple[int, int]], shards: int) -> list[int]:
    """Documents one by one in order of arrival, to the first shard clockwise with room."""
    orders = sharding.clockwise(shards)
    room = [len(arrivals) // shards + (k < len(arrivals) % shards) for k in range(shards)]
    out = []
    for _, place in sorted(arrivals):
        for sign in orders[place]:
            shard = ord(sign) - ord(sharding._sign(0))
            if room[shard]:
                room[shard] -= 1
                out.append(shard)
                break
    return out


@pytest.mark.parametrize(("n", "shards"), [(203, 8), (5, 8), (64, 3)])
def test_shards_equal_one_by_one_assignment(spark, n, shards, monkeypatch):
    held = []
    write = sharding.shared.write_shared
    monkeypatch.setattr(sharding.shared, "write_shared", lambda df, label: held.append(write(df, label)) or held[-1])
    docs = corpus.frame(spark, corpus.plain(n, 5)).withColumn("shard", F.lit("clash"))
    found = sharding.shard(docs, shards, rows_per_stretch=20).collect()
    arrivals = {r["doc_id"]: (r["_arrival"], r["_place"]) for r in held[0].collect()}
    assert sorted(a for a, _ in arrivals.values()) == list(range(n))
    expected = brute_shards(list(arrivals.values()), shards)
    assert [r["shard"] for r in sorted(found, key=lambda r: arrivals[r["doc_id"]])] == expected


def test_shards_of_hot_texts_and_odd_rows(spark):
    rows = corpus.plain(100, 5) + [corpus.row(20_000 + k, "the hot text") for k in range(90)] + corpus.odd()
    found = sharding.shard(corpus.frame(spark, rows), 8, rows_per_stretch=16).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (x[0], len((x[1] or "").encode()) + 1, zlib.crc32((x[1] or "").encode())) for x in rows
    )
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sharding.shard(corpus.frame(spark, [])).count() == 0


def test_a_new_shard_moves_little(spark):
    docs = corpus.frame(spark, corpus.plain(900, 5))
    before = {r["doc_id"]: r["shard"] for r in sharding.shard(docs, 8).collect()}
    after = {r["doc_id"]: r["shard"] for r in sharding.shard(docs, 9).collect()}
    assert sum(before[k] != after[k] for k in before) < 0.5 * len(before)


def test_packing_round_trip_and_limits(spark):
    from tokenizers import Tokenizer

    files = packing.public_files()
    rows = corpus.plain(150, 90) + corpus.odd() + [corpus.row(7, "a <|endoftext|> b")]
    docs = corpus.frame(spark, rows).withColumn("deal", F.lit("clash")).withColumn("length", F.lit("clash"))
    packed = [r.asDict() for r in packing.pack_documents(docs).collect()]
    whole = Tokenizer.from_file(files[0])
    left = Counter()
    for doc_id, text, *_ in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for at in range(0, len(ids), 1024):
            piece = ids[at : at + 1024]
            left[doc_id, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert left == Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in packed)
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        assert len(pieces) <= packing.SEGMENTS
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= -(-sum(r["length"] for r in packed) // 1024) + 2
    assert packing.pack_documents(corpus.frame(spark, [])).count() == 0


def test_all_limits_of_a_bin_hold():
    draw = np.random.default_rng(2)
    sizes = np.column_stack([draw.integers(1, 600, 2000), np.ones(2000, int), draw.integers(0, 300, 2000)])
    sizes[:, 2] = np.minimum(sizes[:, 2], sizes[:, 0])
    limits = np.array([1024, 6, 400])
    bins = packing.place(sizes, limits)
    for k in range(3):
        assert np.bincount(bins, sizes[:, k]).max() <= limits[k]
    least = max(sizes[:, k].sum() / limits[k] for k in range(3))
    assert bins.max() + 1 <= 1.05 * least + 1
    alone = packing.place(np.array([[2000, 1, 0], [2000, 1, 0], [10, 1, 0]]), limits)
    assert len(set(alone)) == 3


def test_lanes_and_loss_tokens(spark):
    rows = [(k, 0, 100 + k % 50, k, 100 + k % 50, k % 7 * 20, k) for k in range(500)]
    examples = spark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss long, deal long")
    packed = packing.pack(examples, loss_tokens=300, segments=5, per_lane=100).collect()
    assert len(packed) == 500
    by = defaultdict(list)
    for r in packed:
        by[r["sequence_id"]].append(r)
    assert all(sum(r["loss"] for r in x) <= 300 and len(x) <= 5 and sum(r["length"] for r in x) <= 1024 for x in by.values())
    assert len({k >> 32 for k in by}) == 5


FRAGMENTS = ["hello", " world", "  ", "\n", "'s", " 12", "!!", "é", " x", "\n\n ", " ", "ab cd", "...", " don't", " ", "日本"]


def test_token_trees_equal_full_encoding():
    coder = packing.encoder(*packing.public_files())
    count = lambda s: len(coder.encode(s))
    draw = random.Random(8)
    for _ in range(300):
        text = "".join(draw.choice(FRAGMENTS) for _ in range(draw.randint(0, 60)))
        tree = editcount.TokenTree(text, count, draw.choice([4, 9, 30]))
        assert tree.tokens == count(text)
        for _ in range(6):
            at, removed = draw.randint(0, len(text) + 3), draw.randint(0, 7)
            inserted = "".join(draw.choice(FRAGMENTS) for _ in range(draw.choice([0, 1, 2, 60])))
            tree.edit(at, removed, inserted)
            at = min(at, len(text))
            text = text[:at] + inserted + text[at + removed :]
            assert tree.text() == text and tree.chars == len(text) and tree.tokens == count(text)


def test_an_edit_encodes_only_its_region():
    coder = packing.encoder(*packing.public_files())
    tree = editcount.TokenTree(corpus.sentence("en", 50_000, 1), lambda s: len(coder.encode(s)))
    before, tree.encoded = tree.tokens, 0
    tree.edit(100_000, 3, "new words")
    assert tree.encoded < 4 * editcount.LEAF and tree.tokens != before


def test_edited_counts_of_a_table(spark):
    coder = packing.encoder(*packing.public_files())
    rows = corpus.plain(30, 80) + corpus.odd()
    docs = corpus.frame(spark, rows).withColumn("n_tokens", F.lit("clash"))
    edits = editcount.drawn_edits(F.col("text"), F.col("doc_id"))
    for r in editcount.count_edited(docs.withColumn("steps", edits), F.col("steps")).collect():
        text = r["text"] or ""
        assert r["counts"]["n_tokens"] == len(coder.encode(text)) and r["n_tokens"] == "clash"
        for step in r["steps"]:
            text = text[: step["at"]] + step["inserted"] + text[step["at"] + step["removed"] :]
        assert r["counts"]["edited_tokens"] == len(coder.encode(text))
        assert r["counts"]["edited_chars"] == len(text)
        assert r["counts"]["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    table = spark.createDataFrame([(0, 2, 0, 1, "B"), (0, 1, 0, 0, "A"), (1, 1, None, None, None), (None, 1, 0, 0, "x")], "doc_id long, seq int, at int, removed int, inserted string")
    joined = editcount.with_edits(corpus.frame(spark, [corpus.row(0, "xyz"), corpus.row(1, "xyz"), corpus.row(None, "xyz")]), table)
    got = {r["doc_id"]: r["counts"]["edited_sha256"] for r in editcount.count_edited(joined, F.col("edits")).collect()}
    assert got[0] == hashlib.sha256(b"Bxyz").hexdigest() and got[1] == got[None] == hashlib.sha256(b"xyz").hexdigest()
    assert editcount.count_edited(corpus.frame(spark, []), F.lit(None).cast("array<struct<at:int,removed:int,inserted:string>>")).count() == 0


PAGE = (
    "<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    "<nav><ul><li><a href='/x'>menu</a></li></ul></nav><div class='ad'>buy</div>"
    "<article><header><h1>Title &amp; more</h1></header><p>First  <b>bold</b>\n text<br>line<p>Second &eacute;&#33;</p>"
    "<aside>side</aside><form>form <input> more</form><div class='comments'><p>me too</p></div>"
    "<ul><li>one<li>two</ul><footer>by me</footer></article><footer>&copy; x</footer>"
)


def test_article_of_a_page(spark):
    pages = [(1, "http://a.example/x", PAGE), (2, None, PAGE), (3, "::bad::", "just <i>text</i>"), (4, "http://a.example/y", None), (5, "http://a.example/z", ""), (1, "http://a.example/x", PAGE)]
    table = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, text string")
    found = {r["page_id"]: r for r in sitestyle.extract(table).collect()}
    expected = "Title & more\nFirst bold text line\nSecond é!\none\ntwo"
    assert found[1]["text"] == found[2]["text"] == expected and found[1]["n_chars"] == len(expected)
    assert (found[3]["text"], found[4]["text"], found[5]["text"]) == ("just text", "", "")
    assert sitestyle.extract(table).count() == 6 and sitestyle.extract(table.limit(0)).count() == 0


def site(k: int) -> str:
    story = "".join(f"<p>{corpus.sentence('en', 30, 1000 * k + j)}</p>" for j in range(3))
    return (
        f"<body><div class='top'><div class='logo'>Our great site</div><div class='links'>Home Contact Shop</div></div>"
        f"<div class='story'><h1>{corpus.sentence('en', 5, k)}</h1>{story}</div><div class='hint'>Call us on weekdays</div></body>"
    )


def test_style_tree_removes_what_a_site_repeats(spark):
    pages = [(k, f"http://site.example/{k}", site(k)) for k in range(40)] + [(900 + k, "http://site.example/0", site(0)) for k in range(60)]
    pages.append((990, "http://other.example/1", site(1)))
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in sitestyle.extract(table).collect()}
    for k in (0, 7, 39, 930):
        own = k if k < 100 else 0
        lines = found[k].split("\n")
        assert lines == [corpus.sentence("en", 5, own), *(corpus.sentence("en", 30, 1000 * own + j) for j in range(3))]
    assert "Our great site" in found[990]
    trees = {r["host"]: r["weak"] for r in sitestyle.style_trees(table.withColumn("host", sitestyle.host_of(F.col("url")))).collect()}
    assert set(trees) == {"site.example"} and any("hint" in s for s in trees["site.example"])


def extracted(spark, bodies: list[str]) -> list[list[str]]:
    pages = [(k, f"http://site.example/{k}", f"<body>{body}</body>") for k, body in enumerate(bodies)]
    found = sitestyle.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    return [r["text"].split("\n") for r in sorted(found, key=lambda r: r["page_id"])]


def test_teaser_articles_and_boilerplate_inside_articles(spark):
    story = [[corpus.sentence("en", 30, 1000 * k + j) for j in range(3)] for k in range(20)]
    text = ["".join(f"<p>{p}</p>" for p in own) for own in story]
    teasers = "".join(f"<article class='card'><p>Read this too, number {j}</p></article>" for j in range(3))
    assert extracted(spark, [f"<div class='story'>{t}</div><div class='row'>{teasers}</div>" for t in text]) == story
    about = "<div class='about'>Our paper has told the news since long ago</div>"
    assert extracted(spark, [f"<div class='wrap'>{about}<article>{t}{about}</article>{about}</div>" for t in text]) == story
    reply = "<article class='comment'><p>me too</p></article>"
    assert extracted(spark, [f"<main>{t}{reply}</main>" for t in text[:2]]) == story[:2]


def test_pipeline_stages_keep_clean_documents(spark, tmp_path):
    import corpus_pipeline

    rows = corpus.plain(160, 70)
    rows += [corpus.row(3000 + k, rows[k][1] + " one more word here", "en", "s1") for k in range(10)]
    rows += [corpus.row(4000 + k, " | ".join(rows[k][1].upper().split()), "en", "s1") for k in range(20)] + corpus.odd()
    corpus.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        kept[name] = docs.collect()
        if name != "pack":
            assert docs.columns == corpus.DOCUMENTS.names
            docs = spark.createDataFrame(kept[name], corpus.DOCUMENTS)
    ids = {name: Counter(r["doc_id"] for r in found) for name, found in kept.items()}
    assert all(k in ids["language"] for k in range(160)) and not {1000, 1001, 1002, 1003} & set(ids["language"])
    assert all(k in ids["quality"] for k in range(160)) and not {4000 + k for k in range(20)} & set(ids["quality"])
    assert all(k in ids["near_duplicates"] for k in range(160)) and not {3000 + k for k in range(10)} & set(ids["near_duplicates"])
    assert ids["near_duplicates"][1004] + ids["near_duplicates"][1005] <= 2
    assert set(ids["mix"]) <= set(ids["near_duplicates"]) and max(ids["mix"].values()) <= 3
    assert set(ids["pack"]) == set(ids["mix"])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(kept["pack"])
