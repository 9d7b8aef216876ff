"""A text classifier: logistic regression on hashed word n-grams, fitted by FTRL-proximal.

Features of a text are its tokens (runs of letters and digits, runs of other signs), pairs of
neighbouring tokens, and pairs of token shapes (small, capital, mixed, digits or signs, length
class, whether the token repeats the one before). Each is hashed to one of 2^``bits`` buckets and
weighs 1 + log(count), scaled to length one per text. A score is one sparse dot product.

Fitting: labelled rows become sparse examples, dealt at random over shards of about
``shard_rows`` and written once, shard by shard. In each of ``rounds`` rounds every shard goes
through its examples from the common state with per-coordinate follow-the-regularised-leader
updates, and the shards' states are averaged, weighted by examples (a shard that is read in two
parts counts as two). A task holds one state (2 x 8 bytes a bucket),
however many examples pass; the driver gets one averaged state a round. ``max_rows`` bounds the
labelled rows that are used: beyond it a random sample of about that size is taken (the documented
bound of the fit; scoring is not bounded). With it the number of shards is bounded too.

Null or empty text: the bias alone, as an example and when scored. Several labels of one id count
as their mean; null labels and labels without a text are left out. Without any label all scores
are 0.5. Rows are scored one by one, repeated ids too. Columns that clash with the result's give
way to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm import tokens as K
from gaugeworks.llm.frames import map_texts
from gaugeworks.operators.lookup import lookup_join
from gaugeworks.session import materialise

BITS = 18
SHARD_ROWS = 8192
MAX_ROWS = 2_000_000
ROUNDS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
FIELDS = "score double, predicted int"
_CHUNKS = 32
_SIGN = K.byte_class(bytes([*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_CAPITAL = K.byte_class(bytes(range(65, 91)))
_DIGIT = K.byte_class(bytes(range(48, 58)))
#: 0: blanks and control signs, 1: letters, digits and everything beyond ASCII, 2: other signs.
_KIND = np.ones(256, np.uint8)
_KIND[:0x21] = 0
_KIND[_SIGN] = 2


def find_tokens(part: K.Slice) -> K.Words:
    """Longest runs of one kind of byte, never across two texts."""
    kind = _KIND[part.data]
    edge = np.ones(len(kind) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[part.offsets] = True
    bounds = np.flatnonzero(edge)
    start, end = bounds[:-1], bounds[1:]
    real = kind[start] > 0 if len(start) else np.zeros(0, bool)
    start, end = start[real], end[real]
    return K.Words(start, end, np.searchsorted(start, part.offsets))


def _shapes(part: K.Slice, words: K.Words, hashes: np.ndarray) -> np.ndarray:
    """A small number per token that tells its looks."""

    def inside(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[part.data])])
        return total[words.end] - total[words.start]

    size = words.end - words.start
    capitals, digits, signs = inside(_CAPITAL), inside(_DIGIT), inside(_SIGN)
    shape = np.select(
        [signs > 0, digits == size, digits > 0, capitals == 0, (capitals == 1) & (size > 1), capitals * 2 > size],
        [0, 1, 2, 3, 4, 5],
        6,
    )
    length = np.minimum(np.log2(np.maximum(size, 1)).astype(np.int64), 7)
    same = np.zeros(len(hashes), np.int64)
    same[1:] = hashes[1:] == hashes[:-1]
    return shape * 16 + length * 2 + same


def sparse_rows(part: K.Slice, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(where each text's features begin, bucket, value), the bias (bucket 2^bits) not included."""
    words = find_tokens(part)
    hashes = K.hash_words(part.data, words.start, words.end)
    owner, n = words.owner, part.hi - part.lo
    shapes = K.mix(_shapes(part, words, hashes).astype(np.uint64) + np.uint64(1))
    inside = np.flatnonzero(K.within(owner, 2))
    keys = [hashes, K.window_hashes(hashes, 2)[inside], K.window_hashes(shapes, 2)[inside]]
    of = np.concatenate([owner, owner[inside], owner[inside]]).astype(np.int64)
    bucket = (np.concatenate(keys) >> np.uint64(64 - bits)).astype(np.int64)
    cell, count = np.unique((of << bits) | bucket, return_counts=True)
    of, bucket, value = cell >> bits, cell & ((1 << bits) - 1), 1 + np.log(count)
    norm = np.sqrt(np.bincount(of, weights=value * value, minlength=n))
    first = np.searchsorted(of, np.arange(n + 1))
    return first, bucket, value / norm[of]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bits: int


def _examples(labelled: DataFrame, text_col: str, bits: int) -> DataFrame:
    """(target, buckets, values) per labelled row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch.column(0)):
                first, bucket, value = sparse_rows(part, bits)
                cut = list(zip(first[:-1], first[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(part.lo, part.hi - part.lo),
                        pa.array([bucket[a:b].astype(np.int32).tobytes() for a, b in cut], pa.binary()),
                        pa.array([value[a:b].astype(np.float32).tobytes() for a, b in cut], pa.binary()),
                    ],
                    ["target", "buckets", "amounts"],
                )

    rows = labelled.select(F.col(text_col).cast("string"), "__target")
    return rows.mapInArrow(run, "target double, buckets binary, amounts binary")


@dataclass(frozen=True)
class Leader:
    """Parameters of the updates."""

    alpha: float = ALPHA
    beta: float = BETA
    l1: float = L1
    l2: float = L2

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        slack = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -slack / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, z: np.ndarray, n: np.ndarray, at: np.ndarray, x: np.ndarray, target: float) -> None:
        """One example, in place."""
        own, seen = z[at], n[at]
        w = self.weights(own, seen)
        gradient = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - target) * x
        more = seen + gradient * gradient
        z[at] = own + gradient - (np.sqrt(more) - np.sqrt(seen)) / self.alpha * w
        n[at] = more


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows one by one: together their arrays would stand beside the batch once more."""
    for values in zip(*batch.columns):
        yield tuple(x.as_py() for x in values)


def _round(examples: DataFrame, z: np.ndarray, n: np.ndarray, leader: Leader) -> tuple[np.ndarray, np.ndarray]:
    """The averaged state after every shard went through its examples once."""
    size = len(z)
    shared = examples.sparkSession.sparkContext.broadcast((z, n))
    edges = np.linspace(0, size, _CHUNKS + 1).astype(int)

    def sent(z: np.ndarray, n: np.ndarray, seen: int) -> pa.RecordBatch:
        cut = list(zip(edges[:-1], edges[1:]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(_CHUNKS, dtype=np.int32)),
                pa.array(np.full(_CHUNKS, seen, np.int64)),
                pa.array([(z[a:b] * seen).tobytes() for a, b in cut], pa.binary()),
                pa.array([(n[a:b] * seen).tobytes() for a, b in cut], pa.binary()),
            ],
            ["chunk", "seen", "z", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seen = None, 0
        for batch in batches:
            for of, target, buckets, amounts in _rows(batch):
                if of != shard:  # shards come one after the other
                    if seen:
                        yield sent(z, n, seen)
                    shard, seen = of, 0
                    z, n = (x.copy() for x in shared.value)
                at = np.append(np.frombuffer(buckets, np.int32), size - 1)
                x = np.append(np.frombuffer(amounts, np.float32).astype(np.float64), 1.0)
                leader.learn(z, n, at, x, target)
                seen += 1
        if seen:
            yield sent(z, n, seen)

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, seen, total = None, 0, None

        def mean() -> pa.RecordBatch:
            parts = [pa.array([(x / seen).tobytes()], pa.binary()) for x in total]
            return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), *parts], ["chunk", "z", "n"])

        for batch in batches:
            for of, rows, *raw in _rows(batch):
                both = [np.frombuffer(r, np.float64) for r in raw]
                if of != chunk:
                    if seen:
                        yield mean()
                    chunk, seen, total = of, 0, [np.zeros(len(both[0])) for _ in both]
                seen += rows
                for own, more in zip(total, both):
                    own += more
        if seen:
            yield mean()

    states = examples.mapInArrow(run, "chunk int, seen long, z binary, n binary")
    states = states.repartition(_CHUNKS, "chunk").sortWithinPartitions("chunk", "seen", F.xxhash64("z"))
    rows = states.mapInArrow(average, "chunk int, z binary, n binary").collect()  # one state in all
    shared.destroy()
    rows.sort(key=lambda r: r["chunk"])
    return tuple(np.concatenate([np.frombuffer(r[c], np.float64) for r in rows]) for c in ("z", "n"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    *,
    bits: int = BITS,
    shard_rows: int = SHARD_ROWS,
    max_rows: int = MAX_ROWS,
    rounds: int = ROUNDS,
    leader: Leader = Leader(),
) -> Model:
    """A model of ``label_col`` (0 or 1) from the texts of ``docs`` that have a label."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("__id"))
    known = known.agg(F.avg(F.col(label_col).cast("double")).alias("__target"))
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    texts = texts.filter(F.col("__id").isNotNull())
    labelled = lookup_join(texts, known, ["__id"], "inner").select("__id", "__text", "__target")
    total = labelled.count()
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    if total > max_rows:
        labelled = labelled.filter(F.rand(11) < max_rows / total)
    if total:
        examples = _examples(labelled, "__text", bits)
        shards = max(1, -(-min(total, max_rows) // shard_rows))
        # What is dealt is written once, so it is the same for every round and every retry.
        dealt = examples.repartition(shards).withColumn("shard", F.spark_partition_id())
        dealt = dealt.sortWithinPartitions("shard", F.rand(17))
        dealt = materialise(dealt.select("shard", "target", "buckets", "amounts"), "examples")
        for _ in range(rounds):
            z, n = _round(dealt, z, n, leader)
    return Model(leader.weights(z, n), bits)


def classify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the score (0 to 1, higher: label 1 is likelier) and the predicted label."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bits))

    def job(batch: pa.RecordBatch) -> list[pa.Array]:
        weights, bits = shared.value
        out = [np.zeros(0)]
        for part in K.slices(batch.column(batch.schema.get_field_index(text_col))):
            first, bucket, value = sparse_rows(part, bits)
            of = np.repeat(np.arange(part.hi - part.lo), np.diff(first))
            logit = weights[-1] + np.bincount(of, value * weights[bucket], part.hi - part.lo)
            out.append(1 / (1 + np.exp(-np.clip(logit, -35, 35))))
        score = np.concatenate(out)
        return [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]

    return map_texts(docs, FIELDS, job)
