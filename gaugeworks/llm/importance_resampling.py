"""Drawing documents that look like a target set: importance resampling on hashed n-grams.

Two histograms of hashed word n-grams, one of the documents and one of the target texts, give each
bucket a gain, the log ratio of its smoothed shares in thousandths. A document's weight is the mean
gain of its n-grams. Its score adds Gumbel noise that depends on its id and the seed only, so the
highest scores are a draw without replacement in proportion to the weights, and the same in every
run.

Counting goes by batch concatenation: the texts of a slice are joined with a separator byte
between them, one regular expression pass over the joined bytes finds all words, and an n-gram
counts only if its first and last word lie in the same document, which a search of the words among
the documents' offsets tells. Buckets are CRC-32 values of the n-gram's bytes, continued from word
to word over all n-grams at once, and counted by ``bincount``.

What a task sends are at most ``buckets`` sums. What the driver gets and sends back are the two
histograms. The documents' order comes from a range-partitioned sort of narrow rows (id, weight,
score): a hot score is split by the ids, and the rows of each partition are counted, so no task
ranks all rows.

Null or empty text: no features, weight 0, a score, never drawn (too few words). A null id takes
its noise from the empty id. Rows are judged one by one; rows of one id have the same noise and
rank next to each other when their texts are the same, in the order of their features otherwise.
An empty target or an empty table is no error: all gains then come from smoothing alone. Result
columns are fixed, so other columns of the documents cannot clash with them.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm import tokens as K
from gaugeworks.llm.frames import text_of
from gaugeworks.session import materialise

BUCKETS = 10_000
NGRAMS = 2
MIN_WORDS = 20
PERCENT = 25
SEED = 7
#: Bytes of a word that are hashed for all words at once; the rest of a longer one goes by zlib.
LONG = 48
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SENTINEL = b"\x00"


def _crc_table() -> np.ndarray:
    rest = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        rest = np.where(rest & 1, (rest >> 1) ^ np.uint32(0xEDB88320), rest >> 1)
    return rest.astype(np.uint32)


_TABLE = _crc_table()
_FF, _8 = np.uint32(0xFF), np.uint32(8)


def crc_more(crc: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of what ``crc`` stands for followed by data[start:end], for all rows at once."""
    state = ~crc.astype(np.uint32)
    size = end - start
    order = np.argsort(-np.minimum(size, LONG), kind="stable")
    state, at, left = state[order], start[order], size[order]
    rising = -np.minimum(left, LONG)
    for step in range(int(min(size.max(initial=0), LONG))):
        n = int(np.searchsorted(rising, -step, side="left"))
        state[:n] = _TABLE[(state[:n] ^ data[at[:n] + step]) & _FF] ^ (state[:n] >> _8)
    for i in np.flatnonzero(left > LONG):
        rest = data[at[i] + LONG : at[i] + left[i]].tobytes()
        state[i] = ~np.uint32(zlib.crc32(rest, int(~state[i])))
    out = np.empty_like(state)
    out[order] = state
    return ~out


def features(texts: list[bytes], ngrams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per text, text of every feature, bucket of every feature)."""
    joined = _SENTINEL.join(texts).lower()  # of bytes: A-Z only
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    spans = np.array([m.span() for m in _WORD.finditer(joined)], np.int64).reshape(-1, 2)
    start, end = spans[:, 0], spans[:, 1]
    owner = np.searchsorted(offsets, start, side="right") - 1
    data = np.frombuffer(joined, np.uint8)
    crc = crc_more(np.zeros(len(start), np.uint32), data, start, end)
    owners, keys = [owner], [crc]
    for n in range(1, ngrams):
        if len(start) <= n:
            break
        # The previous n-grams, a blank, the next word; those across two documents are masked.
        crc = _blank(crc[:-1])
        crc = crc_more(crc, data, start[n:], end[n:])
        inside = owner[n:] == owner[:-n]
        owners.append(owner[n:][inside])
        keys.append(crc[inside])
    n_words = np.bincount(owner, minlength=len(texts))
    return n_words, np.concatenate(owners), np.concatenate(keys).astype(np.int64) % buckets


def _blank(crc: np.ndarray) -> np.ndarray:
    state = ~crc
    return ~(_TABLE[(state ^ np.uint32(32)) & _FF] ^ (state >> _8))


def _texts(part: K.Slice) -> list[bytes]:
    return [part.text(i) for i in range(part.hi - part.lo)]


def histogram(texts: DataFrame, ngrams: int, buckets: int) -> np.ndarray:
    """Features per bucket over all texts of the one column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in K.slices(batch.column(0)):
                total += np.bincount(features(_texts(part), ngrams, buckets)[2], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    counted = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.collect():  # at most one row per bucket
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares of each bucket, rounded down."""
    buckets = len(source)
    above = (target + 1.0) * float(source.sum() + buckets)
    below = (source + 1.0) * float(target.sum() + buckets)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def ranked(rows: DataFrame, order: list, most: int) -> DataFrame:
    """``rows`` with their rank from 1 in ``order``; null from ``most`` + 1 on.

    Rows are sorted by range and numbered within their partition; the partitions' sizes give where
    each begins. The list of partitions is what is broadcast.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # The upper bits are the partition's number, the lower 33 the row's place in it.
    placed = materialise(placed.withColumn("__place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__place", 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("n")).orderBy("__part").collect()
    before = dict(zip((r["__part"] for r in sizes), np.cumsum([0] + [r["n"] for r in sizes]).tolist()))
    starts = rows.sparkSession.createDataFrame(list(before.items()), "__part int, __before long")
    placed = placed.withColumn("__part", part.cast("int")).join(F.broadcast(starts), "__part")
    rank = F.col("__before") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    rank = F.when(rank <= most, rank).alias("rank")
    return placed.select(*rows.columns, rank)


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    target_text: str = "text",
    ngrams: int = NGRAMS,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score and, if drawn, its rank.

    Of the documents with ``min_words`` words or more, ``percent`` of a hundred are drawn.
    """
    spark = docs.sparkSession
    rows = text_of(docs, id_col, text_col)
    wanted = target.select(F.col(target_text).cast("string").alias("text"))
    gain = gains(
        histogram(rows.select("text"), ngrams, buckets), histogram(wanted, ngrams, buckets)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = [(np.zeros(0, np.int64),) * 3]
            for part in K.slices(batch.column(1)):
                n_words, owner, bucket = features(_texts(part), ngrams, buckets)
                n = np.bincount(owner, minlength=len(n_words))
                # Sums of longs stay far below 2^53, where doubles are exact.
                total = np.bincount(owner, weights=gain[bucket], minlength=len(n_words))
                found.append((n_words, n, total.astype(np.int64) // np.maximum(n, 1)))
            columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, n_words long, n_features long, weight long"
    schema = spark.createDataFrame([], fields).schema
    scored = rows.mapInArrow(run, schema)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digest = F.substring(F.sha2(name.cast("binary"), 256), 1, 8)
    uniform = (F.conv(digest, 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))
    scored = materialise(scored.withColumn("score", F.col("weight") + noise), "scored")
    enough = F.col("n_words") >= min_words
    most = scored.filter(enough).count() * percent // 100
    order = [F.desc("score"), F.asc("doc_id"), F.desc("weight"), F.asc("n_features"), F.asc("n_words")]
    rest = scored.filter(~enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked(scored.filter(enough), order, most).unionByName(rest)
