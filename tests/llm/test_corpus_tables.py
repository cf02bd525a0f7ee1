"""Collocations, vector codes and shards against brute force on small tables."""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections import Counter
from hashlib import md5
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyshelf.llm import collocations, shared, sharding, vector_codes

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- collocations ------------------------------------------------------------------------


def phrases_by_hand(rows, least, first, most_words=5):
    counts, totals = {}, Counter()
    for text, lang in rows:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(w)
            for i in range(len(w)):
                for k in range(1, most_words + 1):
                    if i + k <= len(w):
                        own[tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n, found = totals[lang], []
        held = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in held.items():
            if any(b >= a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in held.items()):
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], n))
        for rank, (score, a, p, left, right, n) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def prose(seed, n):
    rng = random.Random(seed)
    words = ["a", "b", "B", "Été", "new", "york", "New", "city", "x\x1cy", "\x00z", "of"]
    texts = []
    for _ in range(n):
        text = "".join(
            rng.choice(words) + rng.choice([" ", " ", " ", "\t", ". ", ", ", "\n", "  ", "!", "\r", "\x0b"]) for _ in range(rng.randrange(60))
        )
        texts.append((text + "New York city hall " * rng.randrange(3), rng.choice(["en", "de", None])))
    return texts


def found_phrases(spark, rows, **settings):
    frame = spark.createDataFrame([(t, g, "kept", 7) for t, g in rows], "text string, lang string, phrase string, n int")
    return sorted(tuple(r) for r in collocations.collocations(frame, **settings).collect())


@pytest.mark.parametrize("every, bins", [(2, 1 << 16), (32, 1 << 16), (10**12, 1 << 16)])
def test_phrases_equal_brute_force(spark, every, bins):
    shared.ready(spark)
    rows = prose(1, 120) + [(None, "en"), ("", None), ("  \t .. ,", "fr"), ("word", "nl")]
    rows += [("the same long passage stands in many documents, word for word " * 4, "en")] * 9
    rows += [("go " * 3000, "de")]
    for least, first in ((4, 30), (9, 2000)):
        assert found_phrases(spark, rows, least=least, first=first, every=every, most_bins=bins) == phrases_by_hand(rows, least, first)


def test_phrases_scores_past_64_bits(spark):
    shared.ready(spark)
    big = 10**12
    counts = spark.createDataFrame(
        [("en", "", 0, 9 * big), ("en", "a", 1, 3 * big), ("en", "b", 1, 2 * big), ("en", "a b", 2, big + 7)], "lang string, phrase string, words int, n long"
    )
    (row,) = collocations.scored(counts, shared.Scratch(spark, "t")).collect()
    assert row["score"] == 1000 * (big + 7) * 9 * big // (6 * big * big) and (row["l"], row["r"]) == (3 * big, 2 * big)


def test_no_phrases(spark):
    shared.ready(spark)
    assert found_phrases(spark, []) == [] and found_phrases(spark, [("a b", "en"), (None, None)]) == []


def test_parts_of_the_dictionary_send_a_phrase_once_for_many(spark):
    rows = [("en", f"a b \n c{i}", 1) for i in range(400)]
    chunks = spark.createDataFrame(rows, "lang string, chunk string, n long").repartition(100)
    full = collocations.Dense(np.full(1 << 13, 255, np.uint8))
    partial = collocations.partial_counts(chunks, full, full, 10**12, 5).where("phrase = 'a b'").collect()
    assert len(partial) <= 2 * spark.sparkContext.defaultParallelism and sum(r["n"] for r in partial) == 400
    counts = {r["phrase"]: r["n"] for r in collocations.phrase_counts(chunks, full, full, 100, 10**12, 5).collect()}
    assert counts["a b"] == counts["a"] == counts["b"] == 400 and counts[""] == 1200 and len(counts) == 4


# --- vector codes ------------------------------------------------------------------------


def codes_by_hand(rows, parts=4, entries=256, rounds=4):
    kept = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) and abs(x) < 2**18 for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, [int(np.floor(1024 * x)) for x in r[1]]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    v = np.array([[int(np.floor(1024 * np.float64(x))) for x in r[1]] for r in kept], object)
    books, codes, errors = [], [], np.zeros(len(kept), object)
    for p in np.split(v, parts, axis=1):
        book = p[:entries].copy()
        for turn in range(rounds + 1):
            near = [min(range(len(book)), key=lambda e: (((x - book[e]) ** 2).sum(), e)) for x in p]
            if turn < rounds:
                for e in set(near):
                    own = p[[i for i, n in enumerate(near) if n == e]]
                    book[e] = [s // len(own) for s in own.sum(axis=0)]
        codes.append(near)
        books.append(book)
        errors += [((x - book[e]) ** 2).sum() for x, e in zip(p, near)]
    per_label = Counter()
    for r, e in zip(kept, errors):
        per_label[r[2]] += e
    out = Counter((r[0], bytes(c).hex(), e, per_label[r[2]]) for r, c, e in zip(kept, zip(*codes), errors))
    return out, books


def vector_rows(seed, n, dims, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((7, dims)) * scale
    rows = [(i, (centres[i % 7] + rng.standard_normal(dims) * 0.2 * scale * (i % 3)).tolist(), f"l{i % 5}" if i % 4 else None) for i in range(n)]
    return rows + [(n + i, rows[5][1], "l1") for i in range(40)]


@pytest.mark.parametrize("dims, scale, entries, chunk", [(8, 1.0, 16, 64), (4, 60000.0, 9, 50), (16, 0.001, 40, 1024)])
def test_codes_equal_brute_force(spark, dims, scale, entries, chunk):
    shared.ready(spark)
    rows = vector_rows(dims, 260, dims, scale)
    rows += [(900, None, "l1"), (901, [], "l1"), (902, [None] * dims, None), (903, [float("nan")] * dims, "l2"), (904, [1e300] * dims, "l2")]
    rows += [(905, [1.0] * (dims + 1), "l0"), (None, rows[3][1], "l3"), (7, rows[7][1], "l2")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label string, code string, doc int").repartition(3)
    found, books = vector_codes.compress(frame, settings=vector_codes.Settings(entries=entries, chunk=chunk))
    expected, by_hand = codes_by_hand(rows, entries=entries)
    assert all((b == h).all() for b, h in zip(books, by_hand))
    assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in found.collect()) == expected
    back = vector_codes.decode(found.where("vec_id = 11"), books).first()
    entry = [int(back["code"][2 * p : 2 * p + 2], 16) for p in range(4)]
    assert back["vector"] == [float(x) / 1024 for p in range(4) for x in by_hand[p][entry[p]]]


def test_codes_of_rare_labels_and_empty_tables(spark):
    shared.ready(spark)
    rows = [(i, [float(i % 3), 1.0, -1.0, i / 7], str(i)) for i in range(1100)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    found, _ = vector_codes.compress(frame, settings=vector_codes.Settings(entries=4, rounds=1))
    assert all(r["error"] == r["label_error"] for r in found.collect()) and found.count() == 1100
    found, books = vector_codes.compress(frame.limit(0))
    assert found.count() == 0 and books == []
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame([(1, [1.0, 2.0], "a")], "vec_id long, embedding array<double>, label string"))


def test_cover_tree_holds_its_rules():
    rng = np.random.default_rng(5)
    points = np.floor(rng.standard_normal((300, 6)) * 500)
    points[50:80] = points[50]
    tree = vector_codes.CoverTree(points, 4)
    for node in range(len(tree.centre)):
        own = points[tree.order[tree.start[node] : tree.stop[node]]]
        apart = np.sqrt(((own - points[tree.centre[node]]) ** 2).sum(axis=1))
        assert apart.max() <= tree.radius[node] + 1e-6
        assert (tree.sums(np.array([node]))[0] == own.sum(axis=0)).all()
        children = range(tree.first[node], tree.last[node])
        assert sum(tree.stop[c] - tree.start[c] for c in children) in (0, len(own))


# --- shards ------------------------------------------------------------------------------


def shards_by_hand(rows, shards):
    key = lambda t: int(md5((t or "").encode()).hexdigest()[:15], 16)
    sizes = Counter()
    for _, t in rows:
        sizes[key(t)] += len((t or "").encode()) + 8
    ends = np.cumsum([sizes[k] for k in sorted(sizes)]).tolist()

    def cuts(capacity):
        at, out = 0, []
        for _ in range(shards):
            i = bisect_right(ends, at + capacity)
            at = ends[i - 1] if i else 0
            out.append(at)
        return out

    low, high = 0, ends[-1]
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if cuts(middle)[-1] == ends[-1] else (middle + 1, high)
    upto = dict(zip(sorted(sizes), ends))
    return low, [(i, t, sum(c < upto[key(t)] for c in cuts(low))) for i, t in rows]


@pytest.mark.parametrize("most_sums", [64, 1 << 14])
def test_shards_equal_brute_force(spark, most_sums, monkeypatch):
    shared.ready(spark)
    rng = random.Random(most_sums)
    rows = [(i, "x" * int(rng.paretovariate(0.9)) + str(rng.randrange(900))) for i in range(1500)]
    rows += [(5000 + i, "copy " * 20) for i in range(700)] + [(None, None), (7, None), (8, ""), (8, "")]
    frame = spark.createDataFrame([(i, t, 1, "a") for i, t in rows], "doc_id long, text string, shard int, Size string").repartition(5)
    monkeypatch.setattr(sharding.cut_keys, "__defaults__", (most_sums,))
    found = sharding.sharded(frame, 24).collect()
    capacity, expected = shards_by_hand(rows, 24)
    assert Counter((r["doc"]["c0"], r["doc"]["c1"], r["shard"]) for r in found) == Counter(expected)
    per_shard = Counter()
    for r in found:
        per_shard[r["shard"]] += r["size"]
        assert r["text_crc32"] == crc32((r["doc"]["c1"] or "").encode())
    assert max(per_shard.values()) == capacity
    for shard, n in Counter(r["shard"] for r in found).items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))


def test_fewer_groups_than_shards_empty_tables_and_files(spark, tmp_path):
    shared.ready(spark)
    frame = spark.createDataFrame([(i, "same", "s") for i in range(30)] + [(50, "other", "s")], "doc_id long, text string, source string")
    found = sharding.sharded(frame, 24, keep_text=False).collect()
    assert {r["shard"] for r in found} == {0, 1} and sorted(len([r for r in found if r["shard"] == s]) for s in (0, 1)) == [1, 30]
    assert sharding.sharded(frame.limit(0)).count() == 0
    sharding.write_shards(frame, str(tmp_path / "out"), 24)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.groupBy("shard").count().count() == 2
    assert {(r[0], r[1]) for r in back.select("doc.c0", "doc.c1").collect()} == {(r["doc_id"], r["text"]) for r in frame.collect()}


def test_the_search_needs_few_sums(spark):
    """Twenty thousand groups of very different sizes are never listed: the largest answer stays near the bound."""
    shared.ready(spark)
    rows = spark.range(20000).select(
        F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 15), 16, 10).cast("long").alias("key"),
        (F.pmod(F.xxhash64("id"), F.lit(997)) * F.when(F.col("id") % 50 == 0, 100).otherwise(1) + 8).alias("size"),
    )
    listed = sorted(tuple(r) for r in rows.collect())
    ends = np.cumsum([s for _, s in listed]).tolist()
    whole = [sharding.Sums(60, k, s, k, True) for k, s in listed]
    capacity = sharding.smallest_capacity(whole, ends, 24, False)
    expected = [listed[bisect_right(ends, e)][0] for e in sharding.fill(whole, ends, capacity, 24, False) if e < ends[-1]]
    assert sharding.cut_keys(rows, 24) == expected
