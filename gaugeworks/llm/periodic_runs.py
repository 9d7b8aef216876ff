"""Runs of repeating word sequences, found by block convolution, and texts without the repeats.

A run is a stretch of words with smallest period q (words q apart are the same) that is at least
``min_words`` and ``min_repeats`` times q long and that no neighbouring word extends. The search
goes scale by scale: block length B is ``BLOCK`` words, then twice that, and so on, for the
periods from B to 2 B - 1 (the first scale also has those below). A run of such a period holds a
whole block of the grid of step B together with the block's copy q words on. The sum of squared
differences between a block and every place of the window after it comes from one cyclic
convolution, computed exactly by number-theoretic transforms modulo primes whose product exceeds
the largest possible sum; where it is zero, the block occurs again. Neighbouring blocks that occur
again at the same distance make one seed, which is extended word by word in both directions.

Two exact tests spare convolutions. A block can occur again only if each of its runs of
``SHINGLE`` words occurs again within the window. And a block whose whole window lies in a run
that a smaller scale found has no other stretch: two periods of a stretch that is as long as both
together are multiples of one (Fine and Wilf). Multiples of a period give the same stretch, of
which the smallest period stays.

Texts are taken in slices of about a megabyte, a longer text alone, and nothing is shuffled.
Memory is a multiple of the slice; a text of more than 50 million words is refused, since the
transforms end there. Words are compared by 64-bit hashes.

Null or empty text: no words, no runs, an empty collapsed text. Rows are judged one by one, so
repeated ids do no harm. Columns that clash with the result's give way to it.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeworks.llm import tokens as K
from gaugeworks.llm.frames import map_texts

MIN_WORDS = 24
MIN_REPEATS = 3
BLOCK = 8
SHINGLE = 4
#: Primes with a root of unity of order 2^25 or more, and a generator of each.
PRIMES = ((2013265921, 31), (1811939329, 13), (2113929217, 5))
#: Words of blocks that are transformed together.
CELLS = 1 << 20
RUN = "struct<start:long,length:long,period:long>"
FIELDS = f"n_words long, n_runs long, runs array<{RUN}>, best {RUN}, collapsed string"
_FAR = np.iinfo(np.int64).max


def _roots(prime: int, generator: int, half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 ``half``."""
    root = pow(generator, (prime - 1) // (2 * half), prime)
    if inverse:
        root = pow(root, prime - 2, prime)
    out, size = np.ones(half, np.uint64), 1
    while size < half:
        step = np.uint64(pow(root, size, prime))
        out[size : 2 * size] = out[:size] * step % np.uint64(prime)
        size *= 2
    return out


def _transform(a: np.ndarray, prime: int, generator: int) -> None:
    """Forward transform along the first axis, in place; results are in bit-reversed order."""
    p, half = np.uint64(prime), a.shape[0] // 2
    while half:
        pairs = a.reshape(-1, 2, half, a.shape[1])
        low, high = pairs[:, 0], pairs[:, 1]
        gap = (low + (p - high)) * _roots(prime, generator, half, False)[:, None] % p
        pairs[:, 0] = (low + high) % p
        pairs[:, 1] = gap
        half //= 2


def _back(a: np.ndarray, prime: int, generator: int) -> None:
    """Inverse of ``_transform``, from bit-reversed order."""
    p, half = np.uint64(prime), 1
    while half < a.shape[0]:
        pairs = a.reshape(-1, 2, half, a.shape[1])
        low = pairs[:, 0].copy()
        high = pairs[:, 1] * _roots(prime, generator, half, True)[:, None] % p
        pairs[:, 0] = (low + high) % p
        pairs[:, 1] = (low + (p - high)) % p
        half *= 2
    a *= np.uint64(pow(a.shape[0], prime - 2, prime))
    a %= p


def _zero_mod(blocks: np.ndarray, windows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Truth per (shift, pair): the sum of squared differences is zero modulo the prime."""
    p, size = np.uint64(prime), blocks.shape[0]
    blocks, windows = blocks % p, windows % p
    own = (blocks * blocks % p).sum(axis=0) % p
    squares = np.zeros((2 * size + 1, blocks.shape[1]), np.uint64)
    np.cumsum(windows * windows % p, axis=0, out=squares[1:])
    other = (squares[size:-1] - squares[:size]) % p
    kernel = np.zeros(windows.shape, np.uint64)
    kernel[:size] = blocks[::-1]
    cross = windows
    _transform(kernel, prime, generator)
    _transform(cross, prime, generator)
    cross *= kernel
    cross %= p
    _back(cross, prime, generator)
    # Entries from size - 1 on have not wrapped around.
    twice = 2 * cross[size - 1 : 2 * size - 1] % p
    return (own + other) % p == twice[: len(other)]


def occurrences(
    ids: np.ndarray, at: np.ndarray, size: int, gap: int
) -> tuple[np.ndarray, np.ndarray]:
    """(block, shift) for blocks of ``size`` words at ``at`` that occur again at block + gap + shift.

    Shifts run from 0 to size - 1. ``ids`` are numbers of words, below 2^31.
    """
    if 2 * size > 1 << 25:
        raise ValueError("a text has more words than the transforms can take (50 million)")
    top = int(ids.max()) + 1
    primes, product = [], 1
    for prime in PRIMES:
        primes.append(prime)
        product *= prime[0]
        if product > size * top * top:
            break
    padded = np.concatenate([ids.astype(np.uint64), np.full(2 * size + gap, top, np.uint64)])
    found = []
    step = max(1, CELLS // (2 * size))
    for lo in range(0, len(at), step):
        some = at[lo : lo + step]
        blocks = padded[np.arange(size)[:, None] + some]
        windows = padded[np.arange(2 * size)[:, None] + some + gap]
        same = np.ones((size, len(some)), bool)
        for prime, generator in primes:
            same &= _zero_mod(blocks, windows, prime, generator)
            if not same.any():
                break
        shift, which = np.nonzero(same)
        found.append((some[which], shift))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _next_copies(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Distance from each run of ``SHINGLE`` words to its next copy in the text, or very far."""
    inside = K.within(owner, SHINGLE)
    far = np.full(len(hashes), _FAR)
    if not inside.any():
        return far
    place = np.flatnonzero(inside)
    keys = K.chain(K.window_hashes(hashes, SHINGLE), owner[: len(inside)].astype(np.uint64))[place]
    order = np.argsort(keys, kind="stable")
    again = keys[order[1:]] == keys[order[:-1]]
    far[place[order[:-1][again]]] = np.diff(place[order])[again]
    return far


def _extend(
    ids: np.ndarray, first: np.ndarray, last: np.ndarray, gap: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Longest stretches around first..last whose words equal those ``gap`` on, within low..high."""
    start, end = first.copy(), last.copy()
    live, width = np.arange(len(start)), 16
    while len(live):  # to the left
        back = start[live][:, None] - 1 - np.arange(width)
        fits = back >= low[live][:, None]
        back = np.maximum(back, 0)
        fits &= ids[back] == ids[back + gap[live][:, None]]
        grown = np.where(fits.all(axis=1), width, np.argmin(fits, axis=1))
        start[live] -= grown
        live = live[grown == width]
        width = min(2 * width, max(16, CELLS // max(1, len(live))))
    live, width = np.arange(len(start)), 16
    while len(live):  # to the right
        ahead = end[live][:, None] + gap[live][:, None] + np.arange(width)
        fits = ahead < high[live][:, None]
        ahead = np.minimum(ahead, len(ids) - 1)
        fits &= ids[ahead] == ids[ahead - gap[live][:, None]]
        grown = np.where(fits.all(axis=1), width, np.argmin(fits, axis=1))
        end[live] += grown
        live = live[grown == width]
        width = min(2 * width, max(16, CELLS // max(1, len(live))))
    return start, end + gap


class _Runs:
    """Runs found so far, each stretch with its smallest period."""

    def __init__(self) -> None:
        self.start = self.end = self.period = np.zeros(0, np.int64)
        self._reach = self.start

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        start, end, period = (
            np.concatenate(x)
            for x in ((self.start, start), (self.end, end), (self.period, period))
        )
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        new = np.append(True, (np.diff(start) != 0) | (np.diff(end) != 0))[: len(start)]
        self.start, self.end, self.period = start[new], end[new], period[new]
        self._reach = np.maximum.accumulate(self.end) if len(self.end) else self.end

    def hold(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether low..high lies inside a run."""
        if not len(self.start):
            return np.zeros(len(low), bool)
        at = np.searchsorted(self.start, low, side="right") - 1
        return (at >= 0) & (self._reach[np.maximum(at, 0)] >= high)


def find_runs(
    hashes: np.ndarray, bounds: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs of all texts; text i has words bounds[i] to bounds[i + 1]."""
    if min_repeats < 3 or min_words < 3 * BLOCK:
        raise ValueError(f"runs need 3 repeats and {3 * BLOCK} words at least")
    runs, sizes = _Runs(), np.diff(bounds)
    longest = int(sizes.max()) if len(sizes) else 0
    if longest < min_words:
        return runs.start, runs.end, runs.period
    owner = np.repeat(np.arange(len(sizes)), sizes)
    ids = np.unique(hashes, return_inverse=True)[1]
    near = _next_copies(hashes, owner)
    size, gap = BLOCK, 0  # periods below the first block length, then from block length to twice it
    while min_repeats * max(gap, 1) <= longest:
        reach = gap + size - 1
        bad = np.concatenate([[0], np.cumsum(near > reach)])
        at = np.arange(0, len(ids) - size + 1, size)
        at = at[bad[at + size - SHINGLE + 1] == bad[at]]
        at = at[owner[at] == owner[at + size - 1]]
        at = at[~runs.hold(at, at + size + reach)]
        if len(at):
            block, period = occurrences(ids, at, size, gap)
            period = period + gap
            stop = bounds[owner[block] + 1]
            fits = (period > 0) & (block + size + period <= stop)
            fits &= ~runs.hold(block, block + size + period)
            block, period = block[fits], period[fits]
            order = np.lexsort((block, period))
            block, period = block[order], period[order]
            joined = (np.diff(block) == size) & (np.diff(period) == 0)
            joined &= owner[block[1:]] == owner[block[:-1]]
            first = np.flatnonzero(np.append(True, ~joined)[: len(block)])
            last = np.append(first[1:], len(block))[: len(first)] - 1
            text = owner[block[first]]
            step = max(1, CELLS // 64)
            for lo in range(0, len(first), step):
                a, b = first[lo : lo + step], last[lo : lo + step]
                of, q = text[lo : lo + step], period[a]
                start, end = _extend(ids, block[a], block[b] + size, q, bounds[of], bounds[of + 1])
                good = end - start >= np.maximum(min_words, min_repeats * q)
                runs.add(start[good], end[good], q[good])
        if gap:
            size *= 2
        gap = size
    return runs.start, runs.end, runs.period


def _joined(part: K.Slice, words: K.Words, kept: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The kept words of all texts, one blank apart, and where each text begins."""
    counts = np.bincount(words.owner[kept], minlength=len(words.first) - 1)
    start, size = words.start[kept], words.end[kept] - words.start[kept] + 1
    cut = np.concatenate([[0], np.cumsum(size)])
    take = np.repeat(start - cut[:-1], size) + np.arange(cut[-1])
    raw = part.data[np.minimum(take, max(len(part.data) - 1, 0))]
    raw[cut[1:] - 1] = 32
    return raw.tobytes(), cut[np.concatenate([[0], np.cumsum(counts)])]


def collapse_runs(
    docs: DataFrame,
    text_col: str = "text",
    *,
    min_words: int = MIN_WORDS,
    min_repeats: int = MIN_REPEATS,
) -> DataFrame:
    """``docs`` with n_words, n_runs, the runs by start and period, the best run and the rest.

    The best run has the greatest length per period, then the smallest start and period; without
    runs it is null. ``collapsed`` has the words that no run holds after its first period, one
    blank apart.
    """
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def job(batch: pa.RecordBatch) -> list[pa.Array]:
        out: list[list] = [[], [], [], [], []]
        for part in K.slices(batch.column(batch.schema.get_field_index(text_col))):
            words = K.find_words(part.data, part.offsets, K.WHITE)
            hashes = K.hash_words(part.data, words.start, words.end)
            start, end, period = find_runs(hashes, words.first, min_words, min_repeats)
            step = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(step, start + period, 1)
            np.add.at(step, end, -1)
            text, cut = _joined(part, words, np.cumsum(step[:-1]) == 0)
            order = np.lexsort((period, start))
            start, end, period = start[order], end[order], period[order]
            of = np.searchsorted(start, words.first)
            for i in range(part.hi - part.lo):
                mine = [
                    (int(s - words.first[i]), int(e - s), int(q))
                    for s, e, q in zip(*(x[of[i] : of[i + 1]] for x in (start, end, period)))
                ]
                best = max(mine, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
                named = [dict(zip(("start", "length", "period"), r)) for r in mine]
                own = text[cut[i] : max(cut[i + 1] - 1, cut[i])].decode("utf-8", "replace")
                row = (int(words.counts[i]), len(mine), named, named[mine.index(best)] if best else None, own)
                for column, value in zip(out, row):
                    column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.list_(struct), struct, pa.string()]
        return [pa.array(column, kind) for column, kind in zip(out, kinds)]

    return map_texts(docs, FIELDS, job)
