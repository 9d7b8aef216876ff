"""Periodic runs against a plain search, on awkward and seeded random rows."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import periodic_runs as R
from gaugeworks.llm.registry import op11_block_convolution, with_planted_period


def plain_runs(own, min_words=24, min_repeats=3):
    """Every stretch with its smallest period, by comparing all words at all distances."""
    found = {}
    for q in range(1, len(own) // min_repeats + 1):
        i = 0
        while i + q < len(own):
            if own[i] != own[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(own) and own[i] == own[i + q]:
                i += 1
            if i + q - start >= max(min_words, min_repeats * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_collapsed(own, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(own) if i not in gone).decode()


def best_of(runs):
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def random_texts(n, seed=1):
    """Texts of few words with repeats in repeats, cut anywhere."""
    pick = random.Random(seed)
    for _ in range(n):
        own = []
        while len(own) < pick.choice((5, 30, 120, 400)):
            kind = pick.random()
            if kind < 0.4 or not own:
                own += [pick.choice("abcdefgh") for _ in range(pick.randint(1, 12))]
            else:
                size = pick.randint(1, min(len(own), pick.choice((2, 9, 40))))
                own += own[-size:] * pick.randint(1, pick.choice((3, 12)))
                own = own[: len(own) - pick.randint(0, size - 1)] or own
            if pick.random() < 0.1:
                own += ["z"]
        yield " ".join(own[:1500])


def test_transforms_give_exact_sums():
    pick = np.random.default_rng(3)
    for size, gap, top in ((8, 0, 3), (8, 8, 2), (32, 32, 40_000), (256, 256, 2**20)):
        ids = pick.integers(0, top, 3000)
        at = np.sort(pick.choice(len(ids) - size, 40, replace=False))
        for i in at[::4]:  # copies at known distances
            to = i + gap + int(pick.integers(0, size))
            if to + size <= len(ids):
                ids[to : to + size] = ids[i : i + size]
        got = set(zip(*(x.tolist() for x in R.occurrences(ids, at, size, gap))))
        want = {
            (i, s)
            for i in at.tolist()
            for s in range(size)
            if i + gap + s + size <= len(ids) and (ids[i : i + size] == ids[i + gap + s : i + gap + s + size]).all()
        }
        assert {x for x in got if x[0] + gap + x[1] + size <= len(ids)} == want and want


def test_occurrences_use_as_many_primes_as_the_sums_need():
    ids = np.full(64, 2**31 - 2)
    ids[::3] = 0
    got = set(zip(*(x.tolist() for x in R.occurrences(ids, np.array([0, 3]), 8, 8))))
    assert got == {(0, 1), (0, 4), (0, 7), (3, 1), (3, 4), (3, 7)}


def test_runs_match_a_plain_search():
    for text in random_texts(150):
        own = text.encode().split()
        ids = np.unique(np.array(own), return_inverse=True)[1] if own else np.zeros(0, int)
        hashes = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        start, end, period = R.find_runs(hashes, np.array([0, len(own)]))
        got = sorted(zip(start.tolist(), (end - start).tolist(), period.tolist()))
        assert got == plain_runs(own), text


def test_collapse(spark, documents, prose):
    block = prose(5, 700)
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "a " * 23), (6, "a " * 24), (7, "a " * 5000),
        (None, "x y " * 30), (8, ("a " * 10 + "b ") * 40), (9, f"{prose(6, 50)} {block} {block} {block} end"),
        (10, f"{block} {block}"), (11, "x" * 90_000 + " y" * 30), (7, "again"),
        (12, "É à ß " * 20 + "日本語 " * 25), (13, "p q " * 12 + "\n" + "p q r " * 9),
    ] + list(enumerate(random_texts(40, 9), 100))
    got = R.collapse_runs(documents(rows).withColumn("runs", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    for r in got:
        own = (r.text or "").encode().split()
        want = plain_runs(own)
        assert (r.n_words, r.n_runs) == (len(own), len(want))
        assert [(x.start, x.length, x.period) for x in r.runs] == want
        assert (r.best and tuple(r.best)) == best_of(want)
        assert r.collapsed == plain_collapsed(own, want)
    assert R.collapse_runs(documents([])).collect() == []
    with pytest.raises(ValueError):
        R.find_runs(np.zeros(0, np.uint64), np.zeros(1, int), min_words=10)


def test_texts_do_not_repeat_across_rows(documents):
    rows = [(i, "a b c d e f g h") for i in range(50)]
    assert {r.n_runs for r in R.collapse_runs(documents(rows).coalesce(1)).collect()} == {0}


def test_long_text_of_one_word(documents):
    """Half a million equal words: later scales add nothing."""
    row = R.collapse_runs(documents([(1, "w " * 500_000 + "end")])).first()
    assert row.collapsed == "w end" and tuple(row.best) == (0, 500_000, 1) and row.n_runs == 1


def planted(doc_id, text):
    own = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(own)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        own = [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]
    return own


def test_query_columns(spark, prose, tmp_path):
    rows = [(i, None if i == 10 else "" if i == 11 else prose(i, i % 130)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    for r in with_planted_period(df).collect():
        assert (r.text or "").encode().split() == planted(r.doc_id, rows[r.doc_id][1])
    got = op11_block_convolution(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and sum(r.n_runs for r in got) > 10
    for r in got:
        own = planted(r.doc_id, rows[r.doc_id][1])
        runs = plain_runs(own)
        best = best_of(runs) or (None,) * 3
        assert r.n_runs == len(runs) and (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapsed(own, runs).encode()).hexdigest()
