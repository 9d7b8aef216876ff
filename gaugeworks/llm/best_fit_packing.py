"""Best-fit packing by minimum bin slack.

Texts become token ids and an end id; only texts longer than a sequence are cut, into pieces of a
whole sequence and a rest. Pieces of one length are interchangeable, so all that a plan of the
bins needs is how many pieces there are of each length: a table of at most ``capacity`` rows,
whatever the size of the corpus. Per bin, the longest piece left is the seed and a bitset
subset-sum program over the lengths left finds the fullest combination beside it, which is then
removed. The same combination stays the fullest one while its lengths last, so it is applied to
as many bins as they allow in one step. Pieces then get their rank among those of their length
(counted in Spark, in buckets, so a common length is not in one task) and read their bin and
offset from the plan.

Null or empty text: one piece, the end id alone. Each row is packed for itself, repeated ids too.
An empty table gives an empty result. Ties between equal lengths are broken by bucket, id, piece
and checksum. Only the id and the text are read, so clashing columns play no role.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm import tokens as K
from gaugeworks.llm.frames import text_of
from gaugeworks.session import materialise

CAPACITY = 2048
END_ID = 0
CACHE_WORDS = 1_000_000
CACHE_RUNS = 150_000

# Words without these characters split into letters, digits and the rest without further rules.
_ODD = re.compile(r"[^\n!-&(-~À-ÖØ-öø-ÿ]|<\|")
_RUN = re.compile(r"\n|[a-zß-öø-ÿ]+|[0-9]|[^\na-z0-9ß-öø-ÿ]+")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level models write for each byte: itself if it prints, else a new one."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class WordIds:
    """Token ids of white-space separated words, remembered up to a bound.

    The tokenizer drops white space and never joins across it, so the ids of a text are those
    of its words. ``split_runs`` uses the model alone for plain words: for byte-level tokenizers
    that lower-case, split letters, single digits and other characters, and mark word ends.
    """

    def __init__(self, path: str, split_runs: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.split_runs = split_runs
        self.letters = byte_letters()
        self.runs: dict[str, list[int]] = {}
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int64)
        self.ids = array("I")
        self.begin = array("q", [0])

    def _run(self, run: str) -> list[int]:
        text = run if run.isascii() else run.encode().decode("latin-1").translate(self.letters)
        ids = self.runs[run] = [x.id for x in self.model.tokenize(text)]
        return ids

    def _add(self, words: list[bytes]) -> None:
        """Append the ids of new words, which hold no line break."""
        text = b"\n".join(words).decode("utf-8", "replace")
        if not self.split_runs or _ODD.search(text):
            for word in text.split("\n"):
                if self.split_runs and not _ODD.search(word):
                    self._add_plain(word)
                else:
                    self.ids.extend(self.whole.encode(word, add_special_tokens=False).ids)
                    self.begin.append(len(self.ids))
        else:
            self._add_plain(text)

    def _add_plain(self, text: str) -> None:
        known, extend = self.runs.get, self.ids.extend
        for run in _RUN.findall(text.lower()):
            if run == "\n":
                self.begin.append(len(self.ids))
            else:
                extend(known(run) or self._run(run))
        self.begin.append(len(self.ids))

    def lookup(self, data: np.ndarray, words: K.Words) -> np.ndarray:
        """Place of each word in ``begin``; a new word is encoded once."""
        if len(self.keys) > CACHE_WORDS:
            self._clear()
        if len(self.runs) > CACHE_RUNS:
            self.runs.clear()
        hashes = K.hash_words(data, words.start, words.end)
        keys, firsts, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        places = np.empty(len(keys), np.int64)
        places[known] = self.places[at[known]]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            places[fresh] = len(self.begin) - 1 + np.arange(len(fresh))
            raw = data.tobytes()
            starts, ends = words.start[firsts[fresh]], words.end[firsts[fresh]]
            self._add([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
            self.keys = np.insert(self.keys, at[fresh], keys[fresh])
            self.places = np.insert(self.places, at[fresh], places[fresh])
        return places[back]


def text_ids(part: K.Slice, cache: WordIds, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the slice's texts end to end, where each text begins), end ids included."""
    words = K.find_words(part.data, part.offsets, K.WHITE)
    places = cache.lookup(part.data, words)
    begin = np.array(memoryview(cache.begin), np.int64)
    pool = np.array(memoryview(cache.ids), np.uint32)
    sizes = begin[places + 1] - begin[places]
    ends = np.cumsum(sizes)
    n = part.hi - part.lo
    # Each word is moved on by the end ids of the texts before its own.
    to = np.repeat(ends - sizes + words.owner, sizes) + (
        np.arange(int(sizes.sum())) - np.repeat(ends - sizes, sizes)
    )
    source = np.repeat(begin[places], sizes) + (
        np.arange(int(sizes.sum())) - np.repeat(ends - sizes, sizes)
    )
    out = np.full(int(sizes.sum()) + n, end_id, np.uint32)
    out[to] = pool[source]
    upto = np.concatenate([[0], ends])[words.first]
    return out, upto + np.arange(n + 1)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    split_runs: bool = True,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every text."""
    texts = text_of(docs, id_col, text_col)
    schema = T.StructType.fromDDL(
        "piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    )
    schema = T.StructType([texts.schema["doc_id"], *schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordIds(tokenizer, split_runs)
        for batch in batches:
            for part in K.slices(batch.column(1)):
                ids, begin = text_ids(part, cache, end_id)
                row, start, stop, number = [], [], [], []
                for i in range(part.hi - part.lo):
                    for p, at in enumerate(range(int(begin[i]), int(begin[i + 1]), capacity)):
                        row.append(i)
                        number.append(p)
                        start.append(at)
                        stop.append(min(at + capacity, int(begin[i + 1])))
                raw = ids.astype("<u4")
                crcs = [zlib.crc32(raw[a:b]) for a, b in zip(start, stop)]
                where = np.array(row, np.int64)
                arrays = [
                    batch.column(0)[part.lo : part.hi].take(pa.array(where)),
                    pa.array(number, pa.int32()),
                    pa.array(np.array(start, np.int64) - begin[where]),
                    pa.array(np.array(stop, np.int64) - np.array(start, np.int64)),
                    pa.array(crcs, pa.int64()),
                ]
                if with_ids:
                    signed = raw.view(np.int32)
                    arrays.append(
                        pa.array(
                            [signed[a:b] for a, b in zip(start, stop)], pa.list_(pa.int32())
                        )
                    )
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return texts.mapInArrow(run, schema)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths, with how often each, whose sum is the largest possible up to ``room``."""
    reach, goal, mask = 1, 1 << room, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, times = min(counts[length], room // length), 1
        while left > 0 and not reach & goal:
            taken = min(times, left)
            steps.append((length, taken, reach))
            reach |= (reach << (length * taken)) & mask
            left -= taken
            times *= 2
        if reach & goal:
            break
    total = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, taken, before in reversed(steps):
        if not (before >> total) & 1:
            used[length] = used.get(length, 0) + taken
            total -= length * taken
    return used


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, {length: pieces in each of them}), by minimum bin slack."""
    left = {length: n for length, n in histogram.items() if n}
    plan = []
    while left:
        seed = max(left)
        left[seed] -= 1
        used = fullest({k: n for k, n in left.items() if n}, capacity - seed)
        left[seed] += 1
        used[seed] = used.get(seed, 0) + 1
        bins = min(left[k] // n for k, n in used.items())
        for k, n in used.items():
            left[k] -= bins * n
            if not left[k]:
                del left[k]
        plan.append((bins, used))
    return plan


def _intervals(plan: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """Plan by piece: from which rank of a length on which bins and offsets hold."""
    rows, done, base = [], {}, 0
    for bins, used in plan:
        offset = 0
        for length in sorted(used, reverse=True):
            n = used[length]
            rows.append((length, done.get(length, 0), base, n, offset))
            done[length] = done.get(length, 0) + bins * n
            offset += n * length
        base += bins
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "low", "base", "times", "offset"), table))


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found`` (doc_id, piece, length, ids_crc32, ...) with sequence_id and offset."""
    spark = found.sparkSession
    counted = found.groupBy("length").agg(F.count("*").alias("n")).collect()  # <= capacity rows
    histogram = {r["length"]: r["n"] for r in counted}
    table = _intervals(plan_bins(histogram, capacity))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    keyed = found.withColumn(
        "__bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    )
    before = (
        keyed.groupBy("length", "__bucket")
        .agg(F.count("*").alias("__n"))
        .withColumn(
            "__before",
            F.sum("__n").over(Window.partitionBy("length").orderBy("__bucket")) - F.col("__n"),
        )
        .drop("__n")
    )
    in_bucket = Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        keyed.withColumn("__row", F.row_number().over(in_bucket) - 1)
        .join(before, ["length", "__bucket"])
        .select(*found.columns, (F.col("__row") + F.col("__before")).alias("__rank"))
    )
    shared = spark.sparkContext.broadcast(table)
    schema = T.StructType(
        [*found.schema.fields, *T.StructType.fromDDL("sequence_id long, offset long").fields]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        firsts = {int(x): i for i, x in reversed(list(enumerate(table["length"])))}
        lasts = {int(x): i + 1 for i, x in enumerate(table["length"])}
        for batch in batches:
            columns = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            length = columns["length"].to_numpy(zero_copy_only=False)
            rank = columns.pop("__rank").to_numpy(zero_copy_only=False)
            at = np.zeros(len(rank), np.int64)
            for value in np.unique(length):
                mine = length == value
                low, high = firsts[int(value)], lasts[int(value)]
                at[mine] = low + np.searchsorted(table["low"][low:high], rank[mine], "right") - 1
            since = rank - table["low"][at]
            times = table["times"][at]
            sequence = table["base"][at] + since // times
            offset = table["offset"][at] + since % times * length
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(sequence), pa.array(offset)], schema.names
            )

    return ranked.mapInArrow(run, schema)


def best_fit_packing(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    split_runs: bool = True,
    with_ids: bool = False,
) -> DataFrame:
    """Every piece of every text with its sequence and its place there, without gaps."""
    cut = pieces(
        docs, tokenizer, id_col, text_col, capacity=capacity, end_id=end_id,
        split_runs=split_runs, with_ids=with_ids,
    )
    return pack(materialise(cut, "pieces"), capacity)
