"""Importance resampling against a plain version, the quality classifier by held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import quality_classifier as Q
from gaugeworks.llm.importance_resampling import crc_more, features, importance_resample, ranked

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_buckets(text, buckets=10_000):
    own = WORD.findall((text or "").encode().lower().decode())
    return len(own), [
        zlib.crc32(x.encode()) % buckets for x in own + [f"{a} {b}" for a, b in zip(own, own[1:])]
    ]


def plain_resample(rows, items, percent=25, min_words=20, buckets=10_000):
    found = [(i, *plain_buckets(t)) for i, t in rows]
    s = Counter(k for _, _, ks in found for k in ks)
    t = Counter(k for text in items for k in plain_buckets(text)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda k: math.floor(1000 * math.log((t[k] + 1) * (n_s + buckets) / ((s[k] + 1) * (n_t + buckets))))
    out = []
    for i, n, ks in found:
        weight = sum(gain(k) for k in ks) // len(ks) if ks else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, n, len(ks), weight, weight + noise])
    enough = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] if r[0] is not None else -1))
    for rank, r in enumerate(enough, 1):
        r.append(rank if rank <= percent * len(enough) // 100 else None)
    return sorted((tuple(r) + (None,) * (6 - len(r)) for r in out), key=str)


def texts(seed, n):
    pick = random.Random(seed)
    words = ["alpha", "Beta", "été", "x1", "日本", "g", "h" * 60, "tok"] + [f"w{i}" for i in range(80)]
    for i in range(n):
        yield i, pick.choice((" ", "\n", "-", "  ")).join(pick.choice(words) for _ in range(pick.choice((0, 3, 25, 90))))


def test_features_are_masked_at_document_ends():
    rows = ["a b", "", "b", "!!", "c d e " + "L" * 300 + " " + "l" * 49, "É é"]
    n_words, owner, bucket = features([r.encode() for r in rows], 2, 1 << 32)
    assert n_words.tolist() == [2, 0, 1, 0, 5, 2]
    for i, row in enumerate(rows):
        assert sorted(bucket[owner == i].tolist()) == sorted(plain_buckets(row, 1 << 32)[1])
    assert len(features([b"one two three four"], 3, 100)[1]) == 9
    assert [len(x) for x in features([], 2, 100)] == [0, 0, 0]
    assert crc_more(np.zeros(0, np.uint32), np.zeros(0, np.uint8), np.zeros(0, int), np.zeros(0, int)).size == 0


def test_resampling_matches_a_plain_version(spark, documents):
    rows = list(texts(2, 300)) + [(900, None), (901, ""), (902, "tok " * 3000), (None, "alpha beta " * 30)]
    items = [t for _, t in texts(5, 9)] + [None, ""]
    target = spark.createDataFrame([(str(i), t) for i, t in enumerate(items)], "item_id string, text string")
    docs = documents(rows).withColumn("score", F.lit("clash"))
    got = importance_resample(docs, target).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_resample(rows, items)


def test_resampling_of_ties_and_nothing(spark, documents):
    target = spark.createDataFrame([("a", "alpha beta")], "item_id string, text string")
    same = [(7, "alpha beta " * 20)] * 40 + [(8, "alpha beta " * 20)] * 4
    got = importance_resample(documents(same), target).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 12))
    assert len({r.score for r in got if r.doc_id == 7}) == 1
    assert importance_resample(documents([]), target).collect() == []
    none = importance_resample(documents(same), target.limit(0)).collect()
    assert len(none) == 44 and {r.weight for r in none} == {none[0].weight}


def test_ranks_count_across_partitions(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 7).alias("v"))
    got = {r.id: r["rank"] for r in ranked(rows, [F.desc("v"), F.asc("id")], 4000).collect()}
    order = sorted(range(5000), key=lambda i: (-(i % 7), i))
    assert got == {i: (k if k <= 4000 else None) for k, i in enumerate(order, 1)}


def labelled(seed, n):
    """Good rows are prose; bad ones have signs, shouting or one repeated word in them."""
    pick = random.Random(seed)
    words = [a + b for a in ("ba", "ko", "li", "mu") for b in ("ra", "n", "sol", "mi", "te")]
    for i in range(n):
        own = [pick.choice(words) for _ in range(pick.randint(20, 120))]
        good = int(pick.random() < 0.7)
        if not good:
            kind = pick.randint(0, 2)
            own = [w + "$$$" for w in own] if kind == 0 else [w.upper() for w in own] if kind == 1 else own[:1] * len(own)
        yield i, " ".join(own), good


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")


def test_classifier_learns(documents, labels):
    rows = list(labelled(3, 1200))
    docs = documents([(i, t) for i, t, _ in rows])
    seen = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    model = Q.train(docs, labels(seen + [(5000, 1), (None, 1), (3, None)]), shard_rows=200)
    got = {r.doc_id: r for r in Q.classify(docs.withColumn("score", F.lit("clash")), model).collect()}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(got[i].predicted == y for i, y in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_updates_match_plain_ones():
    """One shard is plain FTRL-proximal over its rows, coordinate by coordinate."""
    leader, size, pick = Q.Leader(), 12, random.Random(4)
    z, n = np.zeros(size), np.zeros(size)
    plain_z, plain_n = [0.0] * size, [0.0] * size

    def weight(i):
        if abs(plain_z[i]) <= leader.l1:
            return 0.0
        sign = math.copysign(1, plain_z[i])
        return -(plain_z[i] - sign * leader.l1) / ((leader.beta + math.sqrt(plain_n[i])) / leader.alpha + leader.l2)

    for _ in range(200):
        at = sorted(pick.sample(range(size), 5))
        x, target = [pick.random() for _ in at], pick.randint(0, 1)
        w = [weight(i) for i in at]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x))))
        for i, v, own in zip(at, x, w):
            g = (p - target) * v
            plain_z[i] += g - (math.sqrt(plain_n[i] + g * g) - math.sqrt(plain_n[i])) / leader.alpha * own
            plain_n[i] += g * g
        leader.learn(z, n, np.array(at), np.array(x), target)
    assert np.allclose(z, plain_z) and np.allclose(n, plain_n)


def test_classifier_on_awkward_rows(spark, documents, labels):
    rows = [(1, None), (2, ""), (3, "word"), (3, "word"), (None, "no id"), (4, "É  x" * 9000)]
    docs = documents(rows)
    empty = Q.classify(docs, Q.train(docs, labels([]))).collect()
    assert [r.score for r in empty] == [0.5] * len(rows)
    model = Q.train(docs, labels([(1, 1), (1, 0), (3, 1), (4, 0)]), max_rows=3)
    got = Q.classify(docs, model).collect()
    assert len(got) == len(rows)
    assert len({r.score for r in got if r.text in (None, "")}) == 1
    assert len({r.score for r in got if r.text == "word"}) == 1
    assert Q.classify(documents([]), model).collect() == []


def test_sample_bound(documents, labels):
    rows = list(labelled(8, 400))
    docs = documents([(i, t) for i, t, _ in rows])
    model = Q.train(docs, labels([(i, y) for i, _, y in rows]), max_rows=200, shard_rows=50)
    got = {r.doc_id: r.predicted for r in Q.classify(docs, model).collect()}
    assert sum(got[i] == y for i, _, y in rows) >= 0.9 * len(rows)
