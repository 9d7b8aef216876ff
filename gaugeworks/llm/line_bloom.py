"""Line dedup with two Bloom filters.

Pass 1: tasks send the hashes of their line keys, packed by hash range (``packed``). Each range
feeds its keys into two Bloom filters, once-seen and twice-seen; only the twice-seen bits come
back. Pass 2: a line whose key is not in the twice-seen filter is in one document only and stays
where it is. Only the suspected repeats shuffle, as 128-bit digests: they are counted exactly by
document, which removes the filter's false suspects, and the largest document id that holds a key
keeps its lines. Pass 3: documents drop their lines of the confirmed keys.

The filters have ``BITS_PER_KEY`` bits a key up to ``max_filter_bytes`` in all, which bounds what
is broadcast; beyond that size more keys are suspected, none is missed.

Documents are told apart by id: rows of one id are one document, a null id too (it is the
smallest). Null or empty text: one empty line, too short to be dropped; null stays null. Lines
with nothing but white space have an empty key. Ties cannot occur: ids of one key are distinct.
Input columns named like a new column give way to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm import packed as P
from gaugeworks.llm import tokens as K
from gaugeworks.llm.frames import added, text_of
from gaugeworks.operators.lookup import lookup_join
from gaugeworks.session import materialise

MIN_CHARS = 20
MIN_DOCS = 3
BITS_PER_KEY = 16
PROBES = 4
MAX_FILTER_BYTES = 32 << 20
FLUSH_KEYS = 1_000_000


class Lines:
    """Lines of a slice of texts, their keys' hashes and whether they are long enough."""

    def __init__(self, part: K.Slice, min_chars: int):
        data, offsets = part.data, part.offsets
        breaks = np.flatnonzero(data == 10)
        n = part.hi - part.lo
        per_text = np.diff(np.searchsorted(breaks, offsets)) + 1
        self.first = np.concatenate([[0], np.cumsum(per_text)])
        self.start = np.empty(int(self.first[-1]), np.int64)
        is_first = np.zeros(len(self.start), bool)
        is_first[self.first[:-1]] = True
        self.start[is_first] = offsets[:-1]
        self.start[~is_first] = breaks + 1
        self.end = np.empty_like(self.start)
        is_last = np.zeros(len(self.start), bool)
        is_last[self.first[1:] - 1] = True
        self.end[is_last] = offsets[1:]
        self.end[~is_last] = breaks
        self.owner = np.repeat(np.arange(n), per_text)
        solid = np.append(np.flatnonzero(~K.WHITE[data]), len(data))
        low = np.searchsorted(solid, self.start)
        high = np.searchsorted(solid, self.end)
        empty = low == high
        begin = np.where(empty, self.start, solid[low])
        stop = np.where(empty, self.start, solid[np.maximum(high - 1, 0)] + 1)
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        self.long = np.flatnonzero(chars[stop] - chars[begin] >= min_chars)
        lower = K.LOWER[data]
        self.key = K.hash_words(lower, begin[self.long], stop[self.long])
        self._second = (lower, begin[self.long], stop[self.long])

    def second(self, which: np.ndarray) -> np.ndarray:
        """An independent hash of some long lines: every byte goes in after a changed one."""
        lower, begin, stop = self._second
        return K.hash_words(lower ^ np.uint8(0x5A), begin[which], stop[which])


def _probe(keys: np.ndarray, bits: int) -> np.ndarray:
    """Bit numbers of each key in a filter of 2^bits bits: one row per probe."""
    step = K.mix(keys ^ K._B) | np.uint64(1)
    shift = np.uint64(64 - bits)
    at = K.mix(keys)
    return np.stack([(at + np.uint64(i) * step) >> shift for i in range(PROBES)])


def _holds(filter_bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    masks = np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)
    return ((filter_bits[(at >> np.uint64(3)).astype(np.int64)] & masks) != 0).all(axis=0)


def _put(filter_bits: np.ndarray, at: np.ndarray) -> None:
    at = at.reshape(-1)
    masks = np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)
    np.bitwise_or.at(filter_bits, (at >> np.uint64(3)).astype(np.int64), masks)


def twice_seen(texts: DataFrame, min_chars: int, max_bytes: int) -> DataFrame:
    """(range, bits, filter): the twice-seen filter of each range of line hashes."""
    range_bits = P.range_bits(texts.sparkSession, 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            rows = [
                (part, P.pack(keys[at]), np.packbits(n[at] > 1).tobytes())
                for part, at in P.ranges(keys, range_bits)
            ]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int32()),
                    pa.array([r[1] for r in rows], pa.binary()),
                    pa.array([r[2] for r in rows], pa.binary()),
                ],
                ["part", "keys", "again"],
            )

        for batch in batches:
            for part in K.slices(batch.column(0)):
                lines = Lines(part, min_chars)
                # Once per text: a text's own repeats are no second document.
                order = np.lexsort((lines.key, lines.owner[lines.long]))
                key, owner = lines.key[order], lines.owner[lines.long][order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
                held.append(key[new])
                size += int(new.sum())
                if size >= FLUSH_KEYS:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    def merge(group: pa.Table) -> pa.Table:
        blobs = [x.as_py() for x in group.column("keys")]
        keys = sum(len(x) // 8 for x in blobs)
        most = max(10, (max_bytes * 8 >> range_bits).bit_length() - 1)
        bits = min(most, max(10, (keys * BITS_PER_KEY - 1).bit_length()))
        once, twice = np.zeros(1 << bits >> 3, np.uint8), np.zeros(1 << bits >> 3, np.uint8)
        for blob, again in zip(blobs, group.column("again")):
            own = P.unpack(blob, np.uint64)
            at = _probe(own, bits)
            flags = np.unpackbits(np.frombuffer(again.as_py(), np.uint8), count=len(own)) > 0
            _put(twice, at[:, flags | _holds(once, at)])
            _put(once, at)
        return pa.table(
            {
                "part": pa.array([group.column("part")[0].as_py()], pa.int32()),
                "bits": pa.array([bits], pa.int32()),
                "filter": pa.array([twice.tobytes()], pa.binary()),
            }
        )

    sent = texts.select("text").mapInArrow(send, "part int, keys binary, again binary")
    return sent.groupBy("part").applyInArrow(merge, "part int, bits int, filter binary")


def suspects(texts: DataFrame, filters: list, min_chars: int) -> DataFrame:
    """(doc_id, h1, h2) of lines that the twice-seen filters hold, once per row of ``texts``."""
    range_bits = P.range_bits(texts.sparkSession, 1)
    table = {r["part"]: (r["bits"], bytes(r["filter"])) for r in filters}
    shared = texts.sparkSession.sparkContext.broadcast(table)
    schema = T.StructType(
        [texts.schema["doc_id"], *T.StructType.fromDDL("h1 long, h2 long").fields]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {
            part: (bits, np.frombuffer(raw, np.uint8)) for part, (bits, raw) in shared.value.items()
        }
        shift = np.uint64(64 - range_bits)
        for batch in batches:
            for part in K.slices(batch.column(1)):
                lines = Lines(part, min_chars)
                order = np.argsort(lines.key, kind="stable")
                key = lines.key[order]
                found = np.zeros(len(key), bool)
                for number, at in P.ranges(key, range_bits):
                    if number in held:
                        bits, raw = held[number]
                        found[at] = _holds(raw, _probe(key[at], bits))
                which = order[found]
                owner = lines.owner[lines.long[which]]
                h1, h2 = lines.key[which], lines.second(which)
                order = np.lexsort((h2, h1, owner))
                owner, h1, h2 = owner[order], h1[order], h2[order]
                new = np.ones(len(order), bool)
                new[1:] = (
                    (owner[1:] != owner[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[part.lo : part.hi].take(pa.array(owner[new])),
                        pa.array(h1[new].view(np.int64)),
                        pa.array(h2[new].view(np.int64)),
                    ],
                    schema.names,
                )

    return texts.mapInArrow(run, schema)


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """``docs`` with the kept lines as text, n_lines (before) and n_dropped."""
    texts = text_of(docs, id_col, text_col)
    filters = twice_seen(texts, min_chars, max_filter_bytes).collect()  # bounded bytes
    seen = materialise(suspects(texts, filters, min_chars), "suspects")
    confirmed = (
        seen.groupBy("h1", "h2", "doc_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
        .filter(F.col("n") >= min_docs)
        .drop("n")
    )
    # A common line is a hot key, which lookup_join keeps from gathering in one task.
    held = lookup_join(seen, materialise(confirmed, "repeated"), ["h1", "h2"], "inner")
    # One row per document with drops, which hold no more keys than it has lines.
    drops = (
        held.filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias("__drop_id"))
        .agg(F.collect_set(F.struct("h1", "h2")).alias("__both"))
        .select(
            "__drop_id", F.col("__both.h1").alias("__h1"), F.col("__both.h2").alias("__h2")
        )
    )
    schema = added(docs, f"`{text_col}` string, n_lines long, n_dropped long")
    order = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    kept = [c for c in schema.names if c not in (text_col, "n_lines", "n_dropped")]
    joined = docs.select(*order).join(
        drops, F.col(id_col).eqNullSafe(F.col("__drop_id")), "left"
    ).drop("__drop_id")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            texts = column[text_col].cast(pa.string())
            out, n_lines, n_dropped = [], [], []
            for part in K.slices(texts):
                lines = Lines(part, min_chars)
                n_lines.append(np.diff(lines.first))
                own1 = column["__h1"][part.lo : part.hi].to_pylist()
                own2 = column["__h2"][part.lo : part.hi].to_pylist()
                gone = np.zeros(len(lines.start), bool)
                owner = lines.owner[lines.long]
                mine = np.flatnonzero(np.array([bool(keys) for keys in own1])[owner])
                pairs = [set(zip(a, b)) if a else () for a, b in zip(own1, own2)]
                firsts = lines.key[mine].view(np.int64).tolist()
                seconds = lines.second(mine).view(np.int64).tolist()
                for line, text, *pair in zip(mine, owner[mine], firsts, seconds):
                    gone[lines.long[line]] = tuple(pair) in pairs[text]
                dropped = np.bincount(lines.owner[gone], minlength=part.hi - part.lo)
                n_dropped.append(dropped)
                whole = texts[part.lo : part.hi].to_pylist()
                for i in np.flatnonzero(dropped):
                    own = range(lines.first[i], lines.first[i + 1])
                    stay = [
                        part.data[lines.start[x] : lines.end[x]].tobytes()
                        for x in own
                        if not gone[x]
                    ]
                    whole[i] = b"\n".join(stay).decode("utf-8", "replace")
                out.append(pa.array(whole, pa.string()))
            none = np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(column[c] for c in kept),
                    pa.concat_arrays(out) if out else pa.array([], pa.string()),
                    pa.array(np.concatenate([none, *n_lines]), pa.int64()),
                    pa.array(np.concatenate([none, *n_dropped]), pa.int64()),
                ],
                schema.names,
            )

    return joined.mapInArrow(apply, schema).select(*order, "n_lines", "n_dropped")
