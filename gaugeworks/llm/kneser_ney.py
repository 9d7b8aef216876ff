"""Interpolated modified Kneser-Ney language model of any order from two on.

Counting: tasks send their distinct words and n-grams of the highest order with counts, packed by
range of the context's hash (``packed``), so a common n-gram costs one entry per task and no row
per token is shuffled. A context that holds a large share of all n-grams is spread over all ranges
by its following word; the list of such contexts is bounded by their share. Each range is summed in
one task and written as a file of sorted hash arrays: n-grams (count) and contexts (sum of counts,
how many n-grams occur once, twice, more often). It also says for each n-gram without its first
word how many different first words there are: the counts of the order below, down to words
(count, number of different words before).

Scoring: each worker maps the files into memory and looks up the sorted distinct keys of a slice
of texts, so no part of the model is loaded as a whole or broadcast; of the maps at most ``MAPS``
stay open. Probability of w after h: max(c(hw) - D, 0) / c(h) + gamma(h) * P(w after h without its
first word), down to the words, interpolated with 1 / (V + 1); discounts follow Chen and Goodman.
Words are 64-bit hashes. Before the first word stand start marks; the end of a text is a token.

Null or empty text: the end token alone. Rows are judged one by one, repeated ids too. Nothing to
learn from: V = 0 and every token has probability 1. A context without counts: P(w). Ties play no
role. An empty table gives an empty result and an empty model. Columns that clash with the
result's give way to it.
"""

from __future__ import annotations

import json
import mmap
import tempfile
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm import packed as P
from gaugeworks.llm import tokens as K
from gaugeworks.llm.frames import added
from gaugeworks.session import fresh_path, materialise

ORDER = 2
FLUSH = 2_000_000
MAPS = 8192
# Marks that no word hashes to but by accident.
START, END = np.uint64(0x5D1F3C2B9A87E641), np.uint64(0xE3A1C95B7D204F86)
_TOP = np.uint64(0xFFFF000000000000)
_BLOB = "part int, keys binary, lower binary, words binary, counts binary, sizes binary"
_NAMES = ("keys", "lower", "words", "counts", "sizes")
FIELDS = (
    "n_tokens long, n_known long, train_tokens long, base_score double, score double,"
    " perplexity double"
)


def sequences(part: K.Slice, order: int = 1) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(tokens of the slice's texts end to end, their contexts, where texts begin).

    Contexts are hashes of the 1, 2, .. ``order`` - 1 tokens before.
    """
    data = K.LOWER[part.data]
    words = K.find_words(data, part.offsets, K.WHITE)
    hashes = K.hash_words(data, words.start, words.end)
    n = part.hi - part.lo
    first = words.first + np.arange(n + 1)
    tokens = np.full(len(hashes) + n, END)
    tokens[np.arange(len(hashes)) + words.owner] = hashes
    contexts, before = [], tokens
    for _ in range(1, order):
        before = np.append(START, before[:-1])[: len(tokens)]
        before[first[:-1]] = START
        contexts.append(K.mix(K.chain(K.mix(contexts[-1]), before)) if contexts else before)
    return tokens, contexts, first


def gram_key(context: np.ndarray, word: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Key of an n-gram: high bits of its context, or of itself if the context is hot."""
    own = K.mix(K.chain(K.mix(context), word))
    if not len(hot):
        return (context & _TOP) | (own & ~_TOP)
    spread = np.isin(context, hot)
    return np.where(spread, own, (context & _TOP) | (own & ~_TOP))


def _row(part: int, **arrays: np.ndarray) -> tuple:
    return (part, *(P.pack(arrays[n]) if n in arrays else None for n in _NAMES))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32()] + [pa.binary()] * len(_NAMES)
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", *_NAMES])


def _spaced(held: list) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*held)]


def _word_rows(keys: np.ndarray, counts: np.ndarray, bits: int) -> list[tuple]:
    return [
        _row(part, keys=keys[at], counts=counts[at].astype(np.uint64))
        for part, at in P.ranges(keys, bits)
    ]


def word_counts(texts: DataFrame, bits: int) -> DataFrame:
    """Packed (word, count) by range, each word once."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in K.slices(batch.column(0)):
                keys, n = np.unique(sequences(part)[0], return_counts=True)
                held.append((keys, n))
                size += len(keys)
                if size >= FLUSH:
                    yield _batch(_word_rows(*P.summed(*_spaced(held)), bits))
                    held, size = [], 0
        if held:
            yield _batch(_word_rows(*P.summed(*_spaced(held)), bits))

    def merge(group: pa.Table) -> pa.Table:
        keys, n = _merged_words(group)
        return pa.Table.from_batches(
            [_batch([_row(group.column("part")[0].as_py(), keys=keys, counts=n)])]
        )

    return texts.mapInArrow(send, _BLOB).groupBy("part").applyInArrow(merge, _BLOB)


def _merged_words(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    rows = zip(group.column("keys").to_pylist(), group.column("counts").to_pylist())
    return P.summed(
        *_spaced([(P.unpack(k, np.uint64), P.unpack(n, np.uint64)) for k, n in rows])
    )


def word_totals(words: DataFrame) -> tuple[int, int]:
    """(tokens, distinct tokens)."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [P.unpack(x.as_py(), np.uint64) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(x.sum()) for x in counts]), pa.array([len(x) for x in counts])],
                ["n", "v"],
            )

    row = words.select("counts").mapInArrow(total, "n long, v long").agg(F.sum("n"), F.sum("v"))
    n, v = row.first()
    return n or 0, v or 0


def hot_contexts(words: DataFrame, texts: int, tokens: int, bits: int) -> np.ndarray:
    """Contexts with more than half a range's share of the bigrams: fewer than twice the ranges."""
    least = max(1, tokens >> (bits + 1))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hot = P.unpack(k, np.uint64)[P.unpack(n, np.uint64) > least]
                yield pa.RecordBatch.from_arrays([pa.array(hot.view(np.int64))], ["w"])

    found = [r["w"] for r in words.select("keys", "counts").mapInArrow(pick, "w long").collect()]
    keys = np.array(found, np.int64).view(np.uint64)
    keys = keys[keys != END]  # never a context
    return np.sort(np.append(keys, START)) if texts > least else np.sort(keys)


def hot_long_contexts(texts: DataFrame, order: int, bits: int) -> list[np.ndarray]:
    """Contexts of 2, 3, .. ``order`` - 1 words with more than half a range's share, by length.

    A task names those above a quarter of a range's share of its own tokens. One that is above
    half overall is thereby named with a quarter at least, so the sums leave few.
    """
    if order < 3:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(order - 2)]
        tokens, size = 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            for length, own in enumerate(held):
                keys, n = P.summed(*_spaced(own))
                some = n > (tokens >> (bits + 2))
                columns = (np.full(some.sum(), length), keys[some].view(np.int64), n[some])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["length", "key", "n"])
                own.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1]), pa.array([0]), pa.array([tokens])], ["length", "key", "n"]
            )

        for batch in batches:
            for part in K.slices(batch.column(0)):
                words, contexts, _ = sequences(part, order)
                for own, context in zip(held, contexts[1:]):
                    own.append(np.unique(context, return_counts=True))
                    size += len(own[-1][0])
                tokens += len(words)
                if size >= FLUSH:
                    yield from flush()
                    tokens, size = 0, 0
        if tokens:
            yield from flush()

    named = texts.mapInArrow(run, "length long, key long, n long").groupBy("length", "key")
    named = materialise(named.agg(F.sum("n").alias("n")), "hot-contexts")
    total = named.filter("length < 0").agg(F.sum("n")).first()[0] or 0
    rows = named.filter((F.col("length") >= 0) & (F.col("n") > (total >> (bits + 2)))).collect()
    out = [np.array([r["key"] for r in rows if r["length"] == k], np.int64) for k in range(order - 2)]
    return [np.sort(x.view(np.uint64)) for x in out]


def _gram_rows(
    key: np.ndarray, context: np.ndarray, lower: np.ndarray, word: np.ndarray, n: np.ndarray, bits: int
) -> list[tuple]:
    """Packed rows by range of the key, each n-gram once; ``lower`` has the shorter contexts in rows."""
    part = key >> np.uint64(64 - bits)
    order = np.lexsort((word, context, part))
    part, context, word, n, lower = part[order], context[order], word[order], n[order], lower[:, order]
    new = np.ones(len(part), bool)
    new[1:] = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
    at = np.flatnonzero(new)
    n = np.add.reduceat(n, at).astype(np.uint32)  # of one flush: it holds far fewer n-grams
    part, context, word, lower = part[at], context[at], word[at], lower[:, at]
    cut = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
    rows = []
    for low, high in zip(cut[:-1], cut[1:]):
        own = context[low:high]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        rows.append(
            _row(
                int(part[low]),
                keys=own[first],
                lower=np.ascontiguousarray(lower[:, low + first]).reshape(-1),
                sizes=np.diff(np.append(first, len(own))).astype(np.uint32),
                words=word[low:high],
                counts=n[low:high],
            )
        )
    return rows


def gram_counts(texts: DataFrame, order: int, hot: np.ndarray, bits: int) -> DataFrame:
    """Packed n-grams of the highest order by range of their key: contexts, how many words each has,
    the shorter contexts, words, counts."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            context, word = (np.concatenate(x) for x in zip(*((h[0][-1], h[1]) for h in held)))
            lower = np.zeros((order - 2, len(word)), np.uint64)
            for i in range(order - 2):  # from the longest to the shortest
                lower[i] = np.concatenate([h[0][-2 - i] for h in held])
            key = gram_key(context, word, hot)
            return _batch(_gram_rows(key, context, lower, word, np.ones(len(key), np.int64), bits))

        for batch in batches:
            for part in K.slices(batch.column(0)):
                word, contexts, _ = sequences(part, order)
                held.append((contexts, word))
                size += len(word)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return texts.mapInArrow(send, _BLOB)


def _write(path: str, arrays: list[np.ndarray]) -> None:
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    with system.open_output_stream(place, compression=None) as out:
        for x in arrays:
            out.write(np.ascontiguousarray(x).tobytes())


class Mapped:
    """Arrays of a model file, mapped into memory and read only."""

    def __init__(self, path: str, kinds: list[tuple[str, int]]):
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(path)
        if isinstance(system, fs.LocalFileSystem):
            with open(place, "rb") as f:
                self._map(f, kinds)
            return
        # Elsewhere the file comes over once; its local copy has no name and ends with the task.
        with tempfile.TemporaryFile() as f, system.open_input_stream(place) as stream:
            while block := stream.read(4 << 20):
                f.write(block)
            f.flush()
            self._map(f, kinds)

    def _map(self, f, kinds: list[tuple[str, int]]) -> None:
        raw = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False)
        self.arrays, at = [], 0
        for kind, n in kinds:
            self.arrays.append(np.frombuffer(raw, kind, n, at))
            at += n * np.dtype(kind).itemsize


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in 32 bits if they fit, else in 64."""
    return counts.astype(np.uint32 if not len(counts) or counts.max() < 1 << 32 else np.uint64)


_REDUCED = f"kind string, file string, shape string, {_BLOB}"


def reduce_grams(
    sent: DataFrame, order: int, hot: np.ndarray, below: np.ndarray, bits: int, path: str
) -> DataFrame:
    """Write each range's n-grams and contexts; return what else follows from them.

    Rows: kind 'file' (sizes and types of the arrays, how many n-grams have count 1 to 4), kind
    'lower' (packed n-grams of the order below with the number of different words before them, by
    range; for order two these are words), kind 'hot' (sums of a spread context in this range).
    ``below`` are the spread contexts of the order below.
    """

    def reduce(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        parts: list[tuple] = []
        for row in group.select(list(_NAMES)).to_pylist():
            sizes = P.unpack(row["sizes"], np.uint32)
            contexts = P.unpack(row["keys"], np.uint64)
            if order > 2:
                contexts = np.append(contexts, P.unpack(row["lower"], np.uint64))
            parts.append(
                (
                    contexts.reshape(order - 1, len(sizes)).repeat(sizes, axis=1),
                    P.unpack(row["words"], np.uint64),
                    P.unpack(row["counts"], np.uint32).astype(np.int64),
                )
            )
        contexts = np.concatenate([x[0] for x in parts], axis=1)
        word, n = (np.concatenate([x[i] for x in parts]) for i in (1, 2))
        del parts
        sort = np.lexsort((word, contexts[0]))
        contexts, word, n = contexts[:, sort], word[sort], n[sort]
        before = contexts[0]
        at = np.flatnonzero(np.append(True, (before[1:] != before[:-1]) | (word[1:] != word[:-1])))
        n, contexts, word = np.add.reduceat(n, at), contexts[:, at], word[at]
        before, lower = contexts[0], contexts[1:]
        # Contexts.
        at = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        context = before[at]
        sums = np.stack(
            [np.add.reduceat(x.astype(np.int64), at) for x in (n, n == 1, n == 2, n > 2)]
        )
        spread = np.isin(context, hot)
        key = gram_key(before, word, hot)
        sort = np.argsort(key)
        name = f"{path}/grams-{order}-{part:06d}-{uuid.uuid4().hex}"
        arrays = [key[sort], context[~spread], _narrow(n[sort])]
        arrays += [_narrow(x[~spread]) for x in sums]
        _write(name, arrays)
        shape = json.dumps([(x.dtype.str, len(x)) for x in arrays])
        found = P.pack(np.bincount(np.minimum(n, 5), minlength=6))
        empty = (None,) * len(_NAMES)
        rows: list[tuple] = [("file", name, shape, part, None, None, None, found, None)]
        if order == 2:
            known, times = np.unique(word, return_counts=True)
            for lower_row in _word_rows(known, times, bits):
                rows.append(("lower", None, None, *lower_row))
        else:
            lower_key = gram_key(lower[0], word, below)
            ones = np.ones(len(word), np.int64)
            for lower_row in _gram_rows(lower_key, lower[0], lower[1:], word, ones, bits):
                rows.append(("lower", None, None, *lower_row))
        if spread.any():
            own = _row(part, keys=context[spread], counts=np.ascontiguousarray(sums[:, spread]).reshape(-1))
            rows.append(("hot", None, None, *own))
        kinds = [pa.string()] * 3 + [pa.int32()] + [pa.binary()] * len(empty)
        return pa.table(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
            names=["kind", "file", "shape", "part", *_NAMES],
        )

    return sent.groupBy("part").applyInArrow(reduce, _REDUCED)


def reduce_words(words: DataFrame, befores: DataFrame, path: str) -> DataFrame:
    """Write each range's words with counts; return the file, its size and the counts of counts."""

    def reduce(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        own = group.filter(pa.compute.equal(group.column("kind"), "word"))
        other = group.filter(pa.compute.equal(group.column("kind"), "lower"))
        keys, n = _merged_words(own)
        before = np.zeros(len(keys), np.uint64)
        if other.num_rows:
            known, times = _merged_words(other)
            before[np.searchsorted(keys, known)] = times
        name = f"{path}/words-{part:06d}-{uuid.uuid4().hex}"
        arrays = [keys, n, _narrow(before)]
        _write(name, arrays)
        found = np.bincount(np.minimum(before, 5).astype(np.int64), minlength=6)
        return pa.table(
            {
                "part": pa.array([part], pa.int32()),
                "file": [name],
                "shape": [json.dumps([(x.dtype.str, len(x)) for x in arrays])],
                "counts": pa.array([P.pack(found)], pa.binary()),
                "total": [int(before.sum())],
            }
        )

    both = words.select(F.lit("word").alias("kind"), "part", "keys", "counts").unionByName(
        befores.select("kind", "part", "keys", "counts")
    )
    schema = "part int, file string, shape string, counts binary, total long"
    return both.groupBy("part").applyInArrow(reduce, schema)


def discounts(counts: np.ndarray) -> list[float]:
    """D1, D2, D3+ from the numbers of n-grams with count 1 to 4, kept inside their range."""
    n1, n2, n3, n4 = (float(x) for x in counts[1:5])
    if not n1 or not n2:
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.0), k + 1.0) for k, d in enumerate(raw)]


@dataclass
class Grams:
    """One order: its spread contexts with their sums, files by range, and discounts."""

    hot: np.ndarray
    hot_sums: np.ndarray
    files: dict[int, tuple[str, str]]
    discounts: list[float]


@dataclass
class Model:
    """Where the arrays are, and the few numbers that hold for all of them."""

    bits: int
    tokens: int
    vocabulary: int
    grams: list[Grams]  # of order 2, 3, ..
    words: dict[int, tuple[str, str]]
    word_discounts: list[float]
    word_counts: list[int]
    word_total: int

    @property
    def order(self) -> int:
        return len(self.grams) + 1


def train(docs: DataFrame, text_col: str = "text", path: str | None = None, order: int = ORDER) -> Model:
    """Count all rows of ``docs`` and write the model's files under ``path``."""
    if order < 2:
        raise ValueError("the order must be 2 at least")
    spark = docs.sparkSession
    path = path or fresh_path(spark, "kneser-ney")
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    bits = min(16, P.range_bits(spark, 1))
    words = materialise(word_counts(texts, bits), "words")
    tokens, vocabulary = word_totals(words)
    # A text has one end token, whose count is the number of texts.
    spread = [hot_contexts(words, texts.count(), tokens, bits), *hot_long_contexts(texts, order, bits)]
    none = np.zeros(6, np.int64)
    grams: list[Grams] = []
    sent = gram_counts(texts, order, spread[-1], bits)
    for k in range(order, 1, -1):
        hot, below = spread[k - 2], spread[k - 3] if k > 2 else spread[0]
        reduced = materialise(reduce_grams(sent, k, hot, below, bits, path), f"grams-{k}")
        files = reduced.filter("kind = 'file'").select("part", "file", "shape", "counts").collect()
        sums = np.zeros((4, len(hot)), np.int64)
        for row in reduced.filter("kind = 'hot'").select("keys", "counts").collect():
            # One row per range, for the bounded list of spread contexts.
            at = np.searchsorted(hot, P.unpack(row["keys"], np.uint64))
            sums[:, at] += P.unpack(row["counts"], np.int64).reshape(4, -1)
        found = sum((P.unpack(r["counts"], np.int64) for r in files), none)
        grams.insert(0, Grams(hot, sums, {r["part"]: (r["file"], r["shape"]) for r in files}, discounts(found)))
        sent = reduced.filter("kind = 'lower'").select("part", *_NAMES)
    befores = sent.withColumn("kind", F.lit("lower"))
    rows = materialise(reduce_words(words, befores, path), "word-files").collect()
    in_words = sum((P.unpack(r["counts"], np.int64) for r in rows), none)
    return Model(
        bits,
        tokens,
        vocabulary,
        grams,
        {r["part"]: (r["file"], r["shape"]) for r in rows},
        discounts(in_words),
        [int(in_words[1]), int(in_words[2]), int(in_words[3:].sum())],
        sum(r["total"] for r in rows),
    )


class Scorer:
    """Look-ups in the mapped files of a model."""

    def __init__(self, model: Model):
        self.model = model
        self.files: OrderedDict[str, list[np.ndarray]] = OrderedDict()

    def _arrays(self, files: dict[int, tuple[str, str]], part: int) -> list[np.ndarray] | None:
        if part not in files:
            return None
        name, shape = files[part]
        if name not in self.files:
            if len(self.files) >= MAPS:  # a process may have only so many maps
                self.files.popitem(last=False)
            self.files[name] = Mapped(name, json.loads(shape)).arrays
        self.files.move_to_end(name)
        return self.files[name]

    def _find(self, keys: np.ndarray, files: dict, column: int, values: list[int]) -> list[np.ndarray]:
        """Values of sorted keys, 0 where there is none."""
        out = [np.zeros(len(keys), np.float64) for _ in values]
        for part, at in P.ranges(keys, self.model.bits):
            held = self._arrays(files, part)
            if held is None or not len(held[column]):
                continue
            place = np.minimum(np.searchsorted(held[column], keys[at]), len(held[column]) - 1)
            same = held[column][place] == keys[at]
            for x, value in zip(out, values):
                x[at] = np.where(same, held[value][place], 0)
        return out

    @staticmethod
    def _discount(counts: np.ndarray, d: list[float]) -> np.ndarray:
        return np.maximum(counts - np.array([0.0, *d])[np.minimum(counts, 3).astype(int)], 0.0)

    def scores(self, word: np.ndarray, contexts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """(count, log10 of the base and of the model) of each token."""
        m = self.model
        keys, back = np.unique(word, return_inverse=True)
        count, befores = self._find(keys, m.words, 0, [1, 2])
        base = np.log10((count + 0.5) / (m.tokens + 0.5 * (m.vocabulary + 1)))
        uniform = 1.0 / (m.vocabulary + 1)
        if m.word_total:
            left = sum(d * n for d, n in zip(m.word_discounts, m.word_counts)) / m.word_total
            lower = self._discount(befores, m.word_discounts) / m.word_total + left * uniform
        else:
            lower = np.full(len(keys), uniform)
        count, base, found = count[back], base[back], lower[back]
        for grams, context in zip(m.grams, contexts):  # from short contexts to long ones
            found = self._after(grams, word, context, found)
        return count, base, np.log10(found)

    def _after(self, grams: Grams, word: np.ndarray, context: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probabilities after a context, from those after the shorter one."""
        keys, which = np.unique(context, return_inverse=True)
        total, one, two, more = self._find(keys, grams.files, 1, [3, 4, 5, 6])
        at = np.searchsorted(grams.hot, keys)
        is_hot = np.isin(keys, grams.hot)
        for x, sums in zip((total, one, two, more), grams.hot_sums):
            x[is_hot] = sums[at[is_hot]]
        held = sum(d * x for d, x in zip(grams.discounts, (one, two, more)))
        total, held = total[which], held[which]
        keys, place = np.unique(gram_key(context, word, grams.hot), return_inverse=True)
        (seen,) = self._find(keys, grams.files, 0, [2])
        known = total > 0
        some = np.where(known, total, 1.0)
        upper = self._discount(seen[place], grams.discounts) / some + held / some * lower
        return np.where(known, upper, lower)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with token counts, base score, the model's log10 probability and perplexity."""
    schema = added(docs, FIELDS)
    kept = schema.names[:-6]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)  # names and totals travel, the arrays are mapped here
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for part in K.slices(batch.column(batch.schema.get_field_index(text_col))):
                word, contexts, first = sequences(part, scorer.model.order)
                count, base, log = scorer.scores(word, contexts)
                begin = first[:-1]
                out.append(
                    (
                        np.diff(first),
                        np.add.reduceat((count > 0).astype(np.int64), begin),
                        np.add.reduceat(base, begin),
                        np.add.reduceat(log, begin),
                    )
                )
            if out:
                n, known, base, log = _spaced(out)
            else:
                n = known = np.zeros(0, np.int64)
                base = log = np.zeros(0)
            with np.errstate(over="ignore"):
                perplexity = np.power(10.0, -log / np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.get_field_index(c)) for c in kept),
                    pa.array(n, pa.int64()),
                    pa.array(known, pa.int64()),
                    pa.array(np.full(len(n), scorer.model.tokens), pa.int64()),
                    pa.array(base),
                    pa.array(log),
                    pa.array(perplexity),
                ],
                schema.names,
            )

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column, folds: int = 5, fold: int = 1) -> Column:
    """Whether a document is kept from training, by the checksum of its id as text."""
    checksum = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(checksum, F.lit(folds)) == fold
