"""Substring dedup by recompression.

Rounds name runs of equal symbols and pairs of adjacent symbols. Names are hashes, so the same run
or pair gets the same name in every document without any exchange; each round puts every symbol in
one of two classes by its name and joins a first-class symbol with a second-class one after it.
What a symbol is depends on a few words around it only, and those bounds are carried along: equal
word windows have equal symbols wherever these bounds lie inside the window. So each window picks
one such symbol, the highest and longest, by a rule that looks at nothing outside the window, and
equal windows pick equal symbols. A symbol that one document alone has needs no further look.

1. Documents are dealt into chunks by id. A chunk sends its symbols, packed by hash range
   (``packed``); a range returns one bit per symbol: shared with another document or not.
2. A chunk sends the windows that picked a shared symbol, as 96-bit hashes with the smallest id
   that has them; a range returns the windows that a smaller id has elsewhere.
3. A chunk removes the words of windows that start in a document with a smaller id.

No row per word or window is shuffled, a window that is common costs one entry per chunk, and
texts are shuffled once (all three steps use the same exchange).

Ids are integers. Null text: no words. Texts shorter than a window keep everything. Rows of one id
do not remove each other's words; a null id counts as the largest. Windows are judged on the
input. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm import packed as P
from gaugeworks.llm import tokens as K
from gaugeworks.llm.frames import text_of

WIDTH = 13
LEVELS = 3
CHUNKS_PER_PARTITION = 2
_LAST_ID = np.iinfo(np.int64).max
_SEEDS = K.mix(np.arange(1, 17, dtype=np.uint64))


class Symbols:
    """Symbols of a slice of texts: names, spans, and the words that each depends on."""

    def __init__(self, names, owner, start, end, low, high):
        self.names, self.owner = names, owner
        self.start, self.end, self.low, self.high = start, end, low, high

    @classmethod
    def words(cls, hashes: np.ndarray, owner: np.ndarray) -> Symbols:
        at = np.arange(len(hashes))
        return cls(hashes, owner, at, at + 1, at, at + 1)

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """How far down the symbol before reaches, and how far up the one after.

        At the edge of a text: one word outside it, so no window of the text reaches that far.
        """
        before, after = self.start - 1, self.end + 1
        same = self.owner[1:] == self.owner[:-1]
        before[1:] = np.where(same, self.low[:-1], before[1:])
        after[:-1] = np.where(same, self.high[1:], after[:-1])
        return before, after

    def runs(self) -> Symbols:
        """Each longest run of equal symbols as one; depends on the symbols beside it."""
        if not len(self.names):
            return self
        before, after = self._neighbours()
        new = np.append(
            True, (self.names[1:] != self.names[:-1]) | (self.owner[1:] != self.owner[:-1])
        )
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(new)) - 1
        size = (last - first + 1).astype(np.uint64)
        names = self.names[first]
        names = np.where(size > 1, K.mix(K.chain(names, K.mix(size))), names)
        low = np.minimum(np.minimum.reduceat(self.low, first), before[first])
        high = np.maximum(np.maximum.reduceat(self.high, first), after[last])
        return Symbols(
            names, self.owner[first], self.start[first], self.end[last], low, high
        )

    def pairs(self, seed: np.uint64) -> Symbols:
        """A symbol of the first class and one of the second after it as one.

        A single one depends on the neighbour that it could have been joined with.
        """
        if not len(self.names):
            return self
        before, after = self._neighbours()
        second = (K.mix(self.names ^ seed) >> np.uint64(63)).astype(bool)
        joined = np.zeros(len(second), bool)
        joined[:-1] = ~second[:-1] & second[1:] & (self.owner[:-1] == self.owner[1:])
        stays = np.append(True, ~joined[:-1])
        first = np.flatnonzero(stays)
        last = first + joined[first]
        both = K.mix(K.chain(self.names[first], self.names[last]))
        names = np.where(joined[first], both, self.names[first])
        low = np.minimum(self.low[first], self.low[last])
        high = np.maximum(self.high[first], self.high[last])
        alone = ~joined[first]
        low = np.where(alone & second[first], np.minimum(low, before[first]), low)
        high = np.where(alone & ~second[first], np.maximum(high, after[first]), high)
        return Symbols(names, self.owner[first], self.start[first], self.end[last], low, high)


def anchors(hashes: np.ndarray, owner: np.ndarray, width: int, levels: int) -> np.ndarray:
    """The symbol that each window of ``width`` words picks, as a key."""
    n = max(0, len(hashes) - width + 1)
    best = np.zeros(n, np.uint64)
    stack = [Symbols.words(hashes, owner)]
    for level in range(levels):
        below = stack[-1].runs() if level == 0 else stack[-1]
        stack.append(below.pairs(_SEEDS[level]))
    for symbols in stack[:0:-1]:
        todo = best == 0
        fits = np.flatnonzero(symbols.high - symbols.low <= width)
        names, low, high = symbols.names[fits], symbols.low[fits], symbols.high[fits]
        span = np.minimum(symbols.end[fits] - symbols.start[fits], 15).astype(np.uint64)
        rank = (span << np.uint64(60)) | (names >> np.uint64(4))
        for step in range(width):
            at = high - width + step
            usable = (at <= low) & (at >= 0) & (at < n)
            usable[usable] = todo[at[usable]]
            np.maximum.at(best, at[usable], rank[usable])
    # Nothing but words left, as inside a long run: the largest word hash.
    for at in np.flatnonzero(best == 0)[None, :]:
        for step in range(width):
            best[at] = np.maximum(best[at], hashes[at + step] >> np.uint64(4))
    return K.mix(best)


def _second(hashes: np.ndarray, width: int) -> np.ndarray:
    """32 more bits of each window's hash."""
    return (K.window_hashes(K.mix(hashes ^ K._B), width) >> np.uint64(32)).astype(np.uint32)


def _chunk_slices(table: pa.Table) -> Iterator[tuple[K.Slice, np.ndarray]]:
    """Slices of a chunk's texts with their ids."""
    ids = table.column("doc_id").cast(pa.int64()).combine_chunks().fill_null(_LAST_ID)
    ids = ids.to_numpy(zero_copy_only=False)
    for part in K.slices(table.column("text")):
        yield part, ids[part.lo : part.hi]


def _picked(part: K.Slice, width: int, levels: int):
    """(owner, word hashes, windows inside one text, their anchors) of a slice."""
    words = K.find_words(part.data, part.offsets, K.WHITE)
    hashes = K.hash_words(part.data, words.start, words.end)
    owner = words.owner
    at = np.flatnonzero(K.within(owner, width))
    keys = anchors(hashes, owner, width, levels)[at] if len(at) else np.zeros(0, np.uint64)
    return owner, hashes, at, keys


def _chunk_symbols(table: pa.Table, width: int, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct anchors of a chunk, whether two of its rows have one)."""
    keys, rows, done = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for part, _ in _chunk_slices(table):
        owner, _, at, key = _picked(part, width, levels)
        order = np.lexsort((owner[at], key))
        key, row = key[order], owner[at][order]
        new = np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]))[: len(key)]
        keys.append(key[new])
        rows.append(row[new] + done)
        done += part.hi - part.lo
    found, n = np.unique(np.concatenate(keys), return_counts=True)
    return found, n > 1


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_SENT = pa.schema([("chunk", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("more", pa.binary()), ("ids", pa.binary())])
_SENT_DDL = "chunk int, part int, keys binary, more binary, ids binary"


def repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    width: int = WIDTH,
    levels: int = LEVELS,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every row's words without its repeats."""
    spark = docs.sparkSession
    bits = P.range_bits(spark, 1)
    n_chunks = CHUNKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    texts = text_of(docs, id_col, text_col)
    texts = texts.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(n_chunks)).cast("int"))
    chunks = texts.groupBy("chunk")

    def send_symbols(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        keys, twice = _chunk_symbols(table, width, levels)
        return _table(
            _SENT,
            [
                (chunk, part, P.pack(keys[at]), np.packbits(twice[at]).tobytes(), None)
                for part, at in P.ranges(keys, bits)
            ],
        )

    def share(table: pa.Table) -> pa.Table:
        """One bit per symbol sent: another row has it."""
        sent = [P.unpack(x.as_py(), np.uint64) for x in table.column("keys")]
        twice = [
            np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(k)) > 0
            for x, k in zip(table.column("more"), sent)
        ]
        keys = np.concatenate(sent)
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        equal = ranked[1:] == ranked[:-1]
        shared = np.zeros(len(keys), bool)
        shared[order] = np.append(equal, False) | np.append(False, equal)
        shared |= np.concatenate(twice)
        cut = np.cumsum([0] + [len(k) for k in sent])
        part = table.column("part")[0].as_py()
        return _table(
            _SENT,
            [
                (chunk.as_py(), part, None, np.packbits(shared[a:b]).tobytes(), None)
                for chunk, a, b in zip(table.column("chunk"), cut[:-1], cut[1:])
                if shared[a:b].any()
            ],
        )

    def send_windows(table: pa.Table, bits_back: pa.Table) -> pa.Table:
        if not table.num_rows or not bits_back.num_rows:
            return _table(_SENT, [])
        chunk = table.column("chunk")[0].as_py()
        symbols, _ = _chunk_symbols(table, width, levels)
        shared = np.zeros(len(symbols), bool)
        by_part = dict(zip(bits_back.column("part").to_pylist(), bits_back.column("more").to_pylist()))
        for part, at in P.ranges(symbols, bits):
            if part in by_part:
                flags = np.frombuffer(by_part[part], np.uint8)
                shared[at] = np.unpackbits(flags, count=at.stop - at.start) > 0
        symbols = symbols[shared]
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64))]
        for part, ids in _chunk_slices(table):
            owner, hashes, at, keys = _picked(part, width, levels)
            if not len(at) or not len(symbols):
                continue
            place = np.minimum(np.searchsorted(symbols, keys), len(symbols) - 1)
            at = at[symbols[place] == keys]
            found.append(
                (K.window_hashes(hashes, width)[at], _second(hashes, width)[at], ids[owner[at]])
            )
        key, more, doc = _smallest(*(np.concatenate(x) for x in zip(*found)))
        return _table(
            _SENT,
            [
                (chunk, part, P.pack(key[at]), P.pack(more[at]), P.pack(doc[at]))
                for part, at in P.ranges(key, bits)
            ],
        )

    def earlier(table: pa.Table) -> pa.Table:
        """For each chunk, the windows that a smaller id has in another chunk, with that id."""
        sent = [
            [P.unpack(row[c], kind) for c, kind in (("keys", np.uint64), ("more", np.uint32), ("ids", np.int64))]
            for row in table.select(["keys", "more", "ids"]).to_pylist()
        ]
        key, more, doc = (np.concatenate(x) for x in zip(*sent))
        order = np.lexsort((doc, more, key))
        key, more, doc = key[order], more[order], doc[order]
        new = np.append(True, (key[1:] != key[:-1]) | (more[1:] != more[:-1]))
        first = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        back = np.empty(len(order), np.int64)
        back[order] = first
        cut = np.cumsum([0] + [len(x[0]) for x in sent])
        part, rows = table.column("part")[0].as_py(), []
        for chunk, own, a, b in zip(table.column("chunk").to_pylist(), sent, cut[:-1], cut[1:]):
            late = back[a:b] < own[2]
            if late.any():
                rows.append(
                    (chunk, part, P.pack(own[0][late]), P.pack(own[1][late]), P.pack(back[a:b][late]))
                )
        return _table(_SENT, rows)

    def remove(table: pa.Table, late: pa.Table) -> pa.Table:
        out = _OUT
        if not table.num_rows:
            return _table(out, [])
        known = [
            tuple(
                P.unpack(row[c], kind)
                for c, kind in (("keys", np.uint64), ("more", np.uint32), ("ids", np.int64))
            )
            for row in late.select(["keys", "more", "ids"]).to_pylist()
        ]
        # Own windows count too: the smallest id of the chunk stands for them.
        slices = list(_chunk_slices(table))
        for part, ids in slices:
            words = K.find_words(part.data, part.offsets, K.WHITE)
            hashes = K.hash_words(part.data, words.start, words.end)
            owner = words.owner
            at = np.flatnonzero(K.within(owner, width))
            if len(at):
                key = K.window_hashes(hashes, width)[at]
                known.append((key, _second(hashes, width)[at], ids[owner[at]]))
        if known:
            key, more, doc = _smallest(*(np.concatenate(x) for x in zip(*known)))
        rows = []
        for part, ids in slices:
            words = K.find_words(part.data, part.offsets, K.WHITE)
            hashes = K.hash_words(part.data, words.start, words.end)
            owner, counts = words.owner, words.counts
            at = np.flatnonzero(K.within(owner, width))
            gone = np.zeros(len(hashes), bool)
            if len(at):
                first = doc[_place(key, more, K.window_hashes(hashes, width)[at], _second(hashes, width)[at])]
                gone = K.covered(at[first < ids[owner[at]]], width, len(hashes))
            removed = np.bincount(owner[gone], minlength=len(ids))
            for i in range(len(ids)):
                raw = part.text(i)
                if removed[i]:
                    a, b = words.first[i], words.first[i + 1]
                    stay = [w for w, g in zip(raw.split(), gone[a:b]) if not g]
                else:
                    stay = raw.split()
                rows.append(
                    (None if ids[i] == _LAST_ID else ids[i], counts[i], removed[i], b" ".join(stay).decode("utf-8", "replace"))
                )
        return _table(out, rows)

    sent = chunks.applyInArrow(send_symbols, _SENT_DDL)
    shared = sent.groupBy("part").applyInArrow(share, _SENT_DDL)
    windows = chunks.cogroup(shared.groupBy("chunk")).applyInArrow(send_windows, _SENT_DDL)
    late = windows.groupBy("part").applyInArrow(earlier, _SENT_DDL)
    kept = chunks.cogroup(late.groupBy("chunk")).applyInArrow(
        remove, "doc_id long, n_words long, n_removed long, kept string"
    )
    return kept.withColumn("doc_id", F.col("doc_id").cast(texts.schema["doc_id"].dataType))


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]
)


def _smallest(key: np.ndarray, more: np.ndarray, doc: np.ndarray):
    """Distinct (key, more), sorted, with the smallest id of each."""
    order = np.lexsort((doc, more, key))
    key, more, doc = key[order], more[order], doc[order]
    new = np.append(True, (key[1:] != key[:-1]) | (more[1:] != more[:-1]))[: len(key)]
    return key[new], more[new], doc[new]


def _place(key: np.ndarray, more: np.ndarray, want: np.ndarray, want_more: np.ndarray):
    """Where each wanted (key, more) stands; all of them are there."""
    at = np.searchsorted(key, want)
    while True:  # equal keys with another second part are next to each other
        other = np.flatnonzero(more[at] != want_more)
        if not len(other):
            return at
        at[other] += 1
