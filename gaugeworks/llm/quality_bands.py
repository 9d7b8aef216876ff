"""Quality rules by compression bands.

A text that zstandard shrinks far more than prose of its length is repetitive; one that it
hardly shrinks is noise. Short texts shrink less than long ones, so each length band has its
own limits. A text of a chunk's size or more is also cut into chunks of that size: too large a
share of chunks outside the chunk limits rejects texts that are fine on average only. Bytes left
over at the end are judged in a last chunk of full size, which overlaps the one before.

One row in, one row out, no shuffle; memory follows one slice of texts.

Null or empty text: no words, ratio null, not kept (too few words). Rows are judged one by one,
so repeated ids and ties play no role; an empty table gives an empty result; input columns named
like an output column give way to it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from gaugeworks.llm import tokens as K
from gaugeworks.llm.frames import map_texts

#: (bytes up to, lowest ratio, highest ratio) of the whole text. Random letters, as in encoded
#: bytes, reach 1.35 in long texts by their alphabet alone; prose reaches 1.7 from a kilobyte on.
#: From 257 to 1024 bytes both rise quickly, so bands are narrow there. Measured on words of base64
#: and on passages of manuals, licences (English) and the declaration of human rights (German,
#: Russian, Korean): base64 reaches at most 1.17 at 384 bytes, 1.22 at 512, 1.27 at 768, 1.29 at
#: 1024; prose has 1.16 at least at 257, 1.25 at 385, 1.33 at 513, 1.43 at 769. Up to 256 bytes the
#: two are too close to tell apart.
BANDS = (
    (64, 0.5, 2.5),
    (256, 0.8, 2.8),
    (320, 1.14, 3.2),
    (384, 1.18, 3.2),
    (512, 1.24, 3.2),
    (768, 1.3, 3.2),
    (1_024, 1.36, 3.2),
    (4_096, 1.35, 4.0),
    (16_384, 1.5, 4.5),
    (2**62, 1.6, 5.0),
)
CHUNK_BYTES = 4_096
CHUNK_BAND = (1.4, 4.5)
MAX_BAD_CHUNKS = 0.25
LEVEL = 3
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, ratio double, n_chunks long, n_bad_chunks long, verdict string,"
    " kept boolean"
)
_SYMBOL = K.byte_class(b"#*$%&|<>")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeat_words(hashes: np.ndarray, owner: np.ndarray, n_texts: int, width: int) -> np.ndarray:
    """Words per text inside windows that the text has twice or more."""
    same = K.within(owner, width)
    at = np.flatnonzero(same)
    if not len(at):
        return np.zeros(n_texts, np.int64)
    # The text's number goes into the key, so that only its own windows are equal.
    keys = K.mix(K.window_hashes(hashes, width)[at] ^ K.mix(owner[at].astype(np.uint64) + K._C))
    order = np.argsort(keys)
    ranked = keys[order]
    twin = np.zeros(len(ranked), bool)
    twin[1:] = ranked[1:] == ranked[:-1]
    twin[:-1] |= ranked[1:] == ranked[:-1]
    hit = K.covered(at[order[twin]], width, len(hashes))
    return np.bincount(owner[hit], minlength=n_texts)


def chunk_starts(size: int, chunk_bytes: int) -> list[int]:
    """Where the chunks of a text of ``size`` bytes begin; together they hold all of its bytes."""
    starts = list(range(0, size - chunk_bytes + 1, chunk_bytes))
    if starts and size % chunk_bytes:
        starts.append(size - chunk_bytes)
    return starts


def compression_bands(
    docs: DataFrame,
    text_col: str = "text",
    *,
    bands: Sequence[tuple[int, float, float]] = BANDS,
    chunk_bytes: int = CHUNK_BYTES,
    chunk_band: tuple[float, float] = CHUNK_BAND,
    max_bad_chunks: float = MAX_BAD_CHUNKS,
    level: int = LEVEL,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    repeat_window: int = REPEAT_WINDOW,
) -> DataFrame:
    """``docs`` with counts, ratios and the verdict: kept, base, repetitive, noise or chunks."""
    tops = [b[0] for b in bands]

    def job(batch: pa.RecordBatch) -> list[pa.Array]:
        squeeze = zstandard.ZstdCompressor(level=level).compress
        rows: list[tuple] = []
        for part in K.slices(batch.column(batch.schema.get_field_index(text_col))):
            n = part.hi - part.lo
            words = K.find_words(part.data, part.offsets, K.WHITE)
            hashes = K.hash_words(part.data, words.start, words.end)
            n_words = words.counts
            repeated = repeat_words(hashes, words.owner, n, repeat_window)
            is_char = (part.data & 0xC0) != 0x80
            chars = _per_text(is_char & ~K.WHITE[part.data], part.offsets)
            symbols = _per_text(_SYMBOL[part.data], part.offsets)
            for i in range(n):
                raw = part.text(i)
                lines = [x for x in raw.split(b"\n") if x.strip()]
                failed = n_words[i] < min_words or 100 * repeated[i] > max_repeat_percent * n_words[i]
                ratio, verdict, chunks, bad = None, "base" if failed else "kept", 0, 0
                if raw:
                    ratio = len(raw) / len(squeeze(raw))
                    _, low, high = bands[int(np.searchsorted(tops, len(raw)))]
                    for start in chunk_starts(len(raw), chunk_bytes):
                        at = chunk_bytes / len(squeeze(raw[start : start + chunk_bytes]))
                        bad += not chunk_band[0] <= at <= chunk_band[1]
                        chunks += 1
                    if not failed:
                        if ratio > high:
                            verdict = "repetitive"
                        elif ratio < low:
                            verdict = "noise"
                        elif bad > max_bad_chunks * chunks:
                            verdict = "chunks"
                rows.append(
                    (n_words[i], chars[i], symbols[i], len(lines) - len(set(lines)), repeated[i],
                     bool(failed), ratio, chunks, bad, verdict, verdict == "kept")
                )
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int64(), pa.int64()]
        kinds += [pa.string(), pa.bool_()]
        columns = zip(*rows) if rows else [()] * len(kinds)
        return [pa.array(list(c), kind) for c, kind in zip(columns, kinds)]

    return map_texts(docs, FIELDS, job)
