"""The pipeline against a plain version, and every registered query on the smallest tables."""

import collections
import itertools
import math
import os
import zlib

import duckdb
import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from gaugeworks.llm import quality_bands as Q
from gaugeworks.llm import registry
from test_operators import AWKWARD, TOKENIZER, base_rules, cut_lines, find_leaks, jaccard_groups
from test_operators import edited, five_word_groups

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def passes_bands(text):
    if base_rules(text)[-1]:
        return False
    squeeze = zstandard.ZstdCompressor(level=Q.LEVEL).compress
    raw = text.encode()
    low, high = next(b[1:] for b in Q.BANDS if len(raw) <= b[0])
    chunks = [raw[i : i + Q.CHUNK_BYTES] for i in range(0, len(raw) - Q.CHUNK_BYTES + 1, Q.CHUNK_BYTES)]
    bad = sum(not Q.CHUNK_BAND[0] <= len(c) / len(squeeze(c)) <= Q.CHUNK_BAND[1] for c in chunks)
    return low <= len(raw) / len(squeeze(raw)) <= high and bad <= Q.MAX_BAD_CHUNKS * len(chunks)


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    import random

    def prose(seed, n):
        pick = random.Random(seed)
        heads = [a + b for a in "bklmnrst" for b in ("a", "o", "in", "ur", "el", "es")]
        return " ".join(pick.choice(heads) + pick.choice(heads) + pick.choice(heads) for _ in range(n))

    rows = list(AWKWARD)
    shared = "a line that stands in a good many documents here"
    rows += [(100 + k, f"{prose(k, 80)}\n{shared}\n{prose(200 + k, 40)}") for k in range(8)]
    rows += [(120 + k, prose(1, 150) + f" tail{k}") for k in range(6)]
    rows += [(140, prose(5, 90)), (140, prose(5, 90)), (141, prose(5, 90)), (150, "same words here now " * 200)]
    rows += [(160, prose(6, 60) + " " + prose(900, 15) + " " + prose(7, 60)), (170, prose(8, 3000))]
    items = [(1, prose(900, 15)), (2, "nothing like it " + prose(901, 9)), (3, None)]
    path = str(tmp_path_factory.mktemp("corpus"))
    full = [(i, t, None, "s", None if t is None else len(t)) for i, t in rows]
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(full, ddl).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_stages_and_run(spark, corpus):
    path, rows, items = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality_rules"
    want = [r for r in rows if passes_bands(r[1])]
    stages = [f for _, f in corpus_pipeline.STAGES]
    for k, stage in enumerate(stages[:-1]):
        docs = stage(spark, docs, path)
        assert docs.columns == COLUMNS
        out = f"{path}/stage-{k}"
        docs.write.parquet(out)
        docs = spark.read.parquet(out)
        if k == 1:
            want = [r[:2] for r in cut_lines(want)]
        elif k == 2:
            own = {i: c for i, _, c in jaccard_groups(want)}
            want = [r for r in want if own[r[0]] == r[0]]
        elif k == 3:
            leaks = {r[0] for r in find_leaks(want, items) if r[-1]}
            want = [r for r in want if r[0] not in leaks]
        got = docs.collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(want, key=str)
        assert k == 0 or all(r.n_chars == len(r.text) for r in got)
    assert 3 < len(want) < len(rows)
    exact = Tokenizer.from_file(TOKENIZER)
    pieces = []
    for i, t in want:
        ids = exact.encode(t, add_special_tokens=False).ids + [0]
        for p, at in enumerate(range(0, len(ids), 2048)):
            own = np.array(ids[at : at + 2048], "<u4")
            pieces.append((i, p, at, len(own), zlib.crc32(own.tobytes())))
    for result in (stages[-1](spark, docs, path), corpus_pipeline.run(spark, path)):
        got = result.collect()
        found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got]
        assert sorted(found, key=str) == sorted(pieces, key=str)
        bins = collections.defaultdict(list)
        for r in got:
            bins[r.sequence_id].append((r.offset, r.length))
        for parts in bins.values():
            parts.sort()
            assert [p[0] for p in parts] == [0, *itertools.accumulate(x[1] for x in parts[:-1])]
        assert len(bins) == math.ceil(sum(p[3] for p in pieces) / 2048)


def test_near_copies_of_five_words(spark, documents, prose):
    """Copies between 80 and 90 percent go, also those that 90 percent on three words would keep."""
    base, other = prose(31, 500), prose(32, 500)
    rows = [(1, base), (2, edited(base, 10, "new")), (3, edited(base, 16, "far")), (4, other)]
    rows += [(5, other + " " + prose(33, 75)), (6, other + " " + prose(34, 140)), (7, prose(35, 90))]
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, documents(rows), "").collect()}
    assert kept == {i for i, _, c in five_word_groups(rows) if i == c} == {1, 3, 4, 6, 7}
    assert {2, 5} <= {i for i, _, c in jaccard_groups(rows) if i == c}


def test_empty_corpus(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{corpus[0]}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")
@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = entry_point.queries()[name](spark, SF)
    cursor = con.execute(entry_point.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    want = sorted(map(str, cursor.fetchall()))
    assert sorted(str(tuple(r[c] for c in columns)) for r in found.collect()) == want and want


def test_every_operator_has_a_query():
    names = entry_point.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
