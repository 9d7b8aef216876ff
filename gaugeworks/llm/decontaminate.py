"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item becomes windows of ``width`` consecutive words (an item with fewer words is one
window). Containment of a window in a document is exact, so a document that has it has all its
shingles, in particular the rarest: the necessary prefix of a window is one shingle. Rarity is
counted over all documents, for the benchmark's shingles only. Documents look up their shingles
among the prefix shingles; a match at word p of a shingle that stands at offset o says where the
window would begin (p - o), which must lie inside the document with all its words (positional and
length bound), and is then verified against the whole window.

The benchmark is a stated query set: it is taken in blocks of at most ``block_windows`` windows,
each broadcast on its own, so what is broadcast has a fixed bound however large the benchmark is.
Documents are not shuffled. Beyond one block, hits are carried from block to block beside the
text, through a table, so a worker holds one block at a time.

Null or empty document: no words, clean. Null or empty item: no window, hits nothing. Several
rows of one item id are further texts of that item; a null item id is never reported but its
windows hit. Rows of documents are judged one by one, repeated ids too. Columns that clash with
the result's give way to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm import tokens as K
from gaugeworks.llm.frames import added
from gaugeworks.session import materialise

WIDTH = 10
SHINGLE = 3
BLOCK_WINDOWS = 200_000
_SPANS = "__hit_spans"
FIELDS = "n_words long, n_hit long, items array<string>, contaminated boolean"


def _hashes(part: K.Slice) -> tuple[K.Words, np.ndarray]:
    data = K.LOWER[part.data]
    words = K.find_words(data, part.offsets, K.NOT_ALNUM)
    return words, K.hash_words(data, words.start, words.end)


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(window hash, words, word hashes, item ids): one row per different window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch.column(1)):
                ids = batch.column(0)[part.lo : part.hi].to_pylist()
                words, hashes = _hashes(part)
                out: list[tuple] = []
                for i, item in enumerate(ids):
                    mine = hashes[words.first[i] : words.first[i + 1]]
                    size = min(width, len(mine))
                    if size:
                        keys = K.window_hashes(mine, size)
                        out += [
                            (item, size, int(k), mine[p : p + size].view(np.int64))
                            for p, k in enumerate(keys.view(np.int64))
                        ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)],
                    ["item", "size", "key", "words"],
                )

    kinds = [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
    return (
        benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
        .mapInArrow(run, "item string, size int, key long, words array<long>")
        .groupBy("key", "size")
        .agg(F.first("words").alias("words"), F.collect_set("item").alias("items"))
    )


def _table(rows: list) -> dict:
    """Arrays of one block of windows, which the tasks look up."""
    sizes = np.array([r["size"] for r in rows], np.int64)
    flat = np.concatenate([np.array(r["words"], np.int64) for r in rows]).view(np.uint64)
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    return {
        "keys": np.array([r["key"] for r in rows], np.int64).view(np.uint64),
        "sizes": sizes,
        "words": flat,
        "begins": begins,
        "items": [sorted(r["items"]) for r in rows],
    }


def _shingles(table: dict, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, offset, shingle hash) of every shingle of a block; shorter windows are one."""
    owner, at, keys = [], [], []
    for size in np.unique(table["sizes"]):
        which = np.flatnonzero(table["sizes"] == size)
        rows = table["words"][table["begins"][which][:, None] + np.arange(size)]
        span = min(shingle, size)
        for offset in range(size - span + 1):
            owner.append(which)
            at.append(np.full(len(which), offset))
            acc = np.full(len(which), np.uint64(span))
            for j in range(span):
                acc = K.chain(acc, rows[:, offset + j])
            keys.append(K.mix(acc))
    return np.concatenate(owner), np.concatenate(at), np.concatenate(keys)


def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key among distinct sorted keys, or -1."""
    if not len(sorted_keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == wanted, at, -1)


def _spans(table: dict, shingle: int) -> list[int]:
    return sorted({int(min(shingle, s)) for s in np.unique(table["sizes"])})


def _rarity(texts: DataFrame, table: dict, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The block's shingles and in how many rows of ``texts`` each occurs."""
    keys = np.unique(_shingles(table, shingle)[2])
    shared = texts.sparkSession.sparkContext.broadcast(keys)
    spans = _spans(table, shingle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shared.value
        total = np.zeros(len(keys), np.int64)
        for batch in batches:
            for part in K.slices(batch.column(0)):
                words, hashes = _hashes(part)
                owner = words.owner
                for span in spans:
                    place = _find(keys, K.window_hashes(hashes, span))
                    at = np.flatnonzero((place >= 0) & K.within(owner, span))
                    pairs = np.unique(owner[at] * len(keys) + place[at])
                    total += np.bincount(pairs % len(keys), minlength=len(keys))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["k", "n"])

    counted = texts.select("text").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n"))
    found = np.zeros(len(keys), np.int64)
    for place, n in counted.collect():  # at most one row per shingle of the block
        found[place] = n
    shared.destroy()
    return keys, found


def _prefixes(table: dict, keys: np.ndarray, counts: np.ndarray, shingle: int) -> dict:
    """``table`` with its index: the rarest shingle of every window, ties by hash and place."""
    owner, at, shingles = _shingles(table, shingle)
    order = np.lexsort((at, shingles, counts[_find(keys, shingles)], owner))
    firsts = order[np.searchsorted(owner[order], np.arange(len(table["sizes"])))]
    by_key = firsts[np.argsort(shingles[firsts], kind="stable")]
    index, begins = np.unique(shingles[by_key], return_index=True)
    return table | {
        "index": index,
        "bounds": np.append(begins, len(by_key)),
        "window": owner[by_key],
        "offset": at[by_key],
    }


def _hits(
    table: dict, hashes: np.ndarray, words: K.Words, shingle: int
) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(start words, windows, size) of verified occurrences."""
    owner = words.owner
    for span in _spans(table, shingle):
        place = _find(table["index"], K.window_hashes(hashes, span))
        at = np.flatnonzero((place >= 0) & K.within(owner, span))
        if not len(at):
            continue
        lows = table["bounds"][place[at]]
        fans = table["bounds"][place[at] + 1] - lows
        flat = np.repeat(lows - np.concatenate([[0], np.cumsum(fans)[:-1]]), fans)
        entry = flat + np.arange(int(fans.sum()))
        found = np.repeat(at, fans)
        window, start = table["window"][entry], found - table["offset"][entry]
        size = table["sizes"][window]
        text = owner[found]
        # A shingle of a shorter window has another span and cannot stand for this one.
        fits = (np.minimum(size, shingle) == span) & (start >= words.first[text])
        fits &= start + size <= words.first[text + 1]
        for s in np.unique(size[fits]):
            which = np.flatnonzero(fits & (size == s))
            for lo in range(0, len(which), 1 << 17):  # whole windows are compared word by word
                some = which[lo : lo + (1 << 17)]
                mine = hashes[start[some][:, None] + np.arange(s)]
                theirs = table["words"][table["begins"][window[some]][:, None] + np.arange(s)]
                same = some[(mine == theirs).all(axis=1)]
                yield start[same], window[same], int(s)


def _blocks(
    benchmark: DataFrame, id_col: str, text_col: str, width: int, most: int
) -> Iterator[tuple[dict, bool]]:
    """(block of windows, whether it is the last), one block on the driver at a time."""
    windows = item_windows(benchmark, id_col, text_col, width).persist(StorageLevel.MEMORY_AND_DISK)
    # Twice as many blocks as full ones would be, so that an uneven hash stays below the bound.
    total = windows.count()
    n_blocks = 1 if total <= most else -(-2 * total // most)
    block = F.pmod(F.xxhash64("key", "size"), F.lit(n_blocks))
    for b in range(n_blocks):
        rows = windows.filter(block == b).collect()
        yield (_table(rows) if rows else {}), b == n_blocks - 1
    windows.unpersist()


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    *,
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    shingle: int = SHINGLE,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside an occurrence), items found and the verdict."""
    sc = docs.sparkSession.sparkContext
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    schema = added(docs, FIELDS)
    plain = schema.names[:-4]
    found = docs.select(
        *plain,
        F.lit(None).cast("binary").alias(_SPANS),
        F.lit(None).cast("array<string>").alias("items"),
    )
    for table, last in _blocks(benchmark, item_id, item_text, width, block_windows):
        if table:
            table = _prefixes(table, *_rarity(texts, table, shingle), shingle)
        found = _apply(found, sc.broadcast(table), text_col, shingle, schema if last else None)
        if not last:  # one block in a worker's memory at a time
            found = materialise(found, "decontaminate")
    return found


def _apply(found: DataFrame, shared, text_col: str, shingle: int, final) -> DataFrame:
    """Add the hits of one block; with ``final`` also count them, which ends the work."""
    plain = [c for c in found.columns if c not in (_SPANS, "items")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            spans, items, n_words, n_hit = [], [], [], []
            for part in K.slices(column[text_col]):
                words, hashes = _hashes(part)
                owner, n = words.owner, part.hi - part.lo
                before = column[_SPANS][part.lo : part.hi].to_pylist()
                named = [set(x or ()) for x in column["items"][part.lo : part.hi].to_pylist()]
                starts = [np.zeros(0, np.int64)]
                sizes = [np.zeros(0, np.int64)]
                for i, raw in enumerate(before):
                    if raw:
                        old = np.frombuffer(raw, np.int64).reshape(2, -1)
                        starts.append(old[0] + words.first[i])
                        sizes.append(old[1])
                for start, window, size in _hits(table, hashes, words, shingle) if table else ():
                    starts.append(start)
                    sizes.append(np.full(len(start), size))
                    pairs = np.unique(owner[start] * len(table["sizes"]) + window)
                    for text, w in zip(*divmod(pairs, len(table["sizes"]))):
                        named[text].update(table["items"][w])
                start, size = np.concatenate(starts), np.concatenate(sizes)
                items += [sorted(x) for x in named]
                if final is None:
                    order = np.argsort(start, kind="stable")
                    start, size = start[order], size[order]
                    cut = np.searchsorted(start, words.first)
                    for i in range(n):
                        mine = slice(cut[i], cut[i + 1])
                        both = np.stack([start[mine] - words.first[i], size[mine]])
                        spans.append(both.tobytes() if both.size else None)
                else:
                    step = np.zeros(len(hashes) + 1, np.int64)
                    np.add.at(step, start, 1)
                    np.add.at(step, start + size, -1)
                    hit = np.cumsum(step[:-1]) > 0
                    n_words.append(words.counts)
                    n_hit.append(np.bincount(owner[hit], minlength=n))
            kept = [column[c] for c in plain]
            listed = pa.array(items, pa.list_(pa.string()))
            if final is None:
                arrays = [*kept, pa.array(spans, pa.binary()), listed]
                yield pa.RecordBatch.from_arrays(arrays, [*plain, _SPANS, "items"])
                continue
            total = np.concatenate([np.zeros(0, np.int64), *n_words])
            hits = np.concatenate([np.zeros(0, np.int64), *n_hit])
            arrays = [*kept, pa.array(total), pa.array(hits), listed, pa.array(hits > 0)]
            yield pa.RecordBatch.from_arrays(arrays, final.names)

    return found.mapInArrow(run, final or found.schema)
