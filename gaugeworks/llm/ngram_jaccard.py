"""N-gram Jaccard join with token-combination prefixes, and its components.

A document is the set of its word n-grams. Documents with the same set are one vertex. For the
others the tokens (n-grams) are ordered from rare to frequent, by document counts over all
documents. Two sets that link miss few of each other's tokens, so their prefixes must meet: a
prefix counts a rare token as one, and of the tokens of a frequent class in one block only those
after the first k - 1, since k of them are indexed together. It is extended until it counts more
than a set may miss: fewer where it is the smaller set of a pair than where it is the larger one
(ties: by digest), so each set has a short prefix for the one role and a longer one for the other. Then at least one single rare token, or one combination of k tokens of a
block, is in both prefixes (blocks are cut by hash, with a number that follows the size of the set;
sets near a power of two are also indexed with the next one's number). Tokens that one document
alone has are at the front of the order and are not indexed at all.

Candidates come without all pairs of a group: first each set is verified against one set, that
which shares most signatures with it among the hubs of its signatures. Verified links give
components. Only signatures that still hold several components are looked at again, and there a
set in its smaller role meets those not smaller, across components, whose sizes, tokens of their own and
512-bit parity bitmaps leave a link possible; these bounds never rule out a link. Copies of a
template that differ too much to link have no signature in the smaller role, so they never meet. Groups of copies are one component by then. Every
pair that could join two components is verified, so the components are exact.

Words are lower-cased in A-Z and split at ASCII white space. With fewer words than n the whole
sequence is the one n-gram; null or empty text, or one without words, has no set, links with
nothing and is its own component. Rows of one id are one document for the component id. A null id
is never a component's id unless all its documents have none. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm import packed as P
from gaugeworks.llm import tokens as K
from gaugeworks.llm.components import components
from gaugeworks.llm.frames import text_of
from gaugeworks.llm.line_bloom import _holds, _probe, _put
from gaugeworks.operators.lookup import lookup_join
from gaugeworks.session import materialise

WORDS = 3
PERCENT = 90
#: (from this document count on, tokens per combination).
CLASSES = ((32, 2), (1024, 3))
LISTED_FROM = 4
MAX_LISTED = 2_000_000
MAX_FILTER_BYTES = 32 << 20
FLUSH = 2_000_000
_48 = np.uint64(16)


class Sets:
    """N-gram sets of a slice of texts: hashes in (text, hash) order, sizes and digests."""

    def __init__(self, part: K.Slice, width: int):
        data = K.LOWER[part.data]
        words = K.find_words(data, part.offsets, K.WHITE)
        hashes = K.hash_words(data, words.start, words.end)
        owner, n = words.owner, part.hi - part.lo
        at = np.flatnonzero(K.within(owner, width))
        keys, rows = [K.window_hashes(hashes, width)[at]], [owner[at]]
        for short in range(1, width):
            texts = np.flatnonzero(words.counts == short)
            if len(texts):
                acc = np.full(len(texts), np.uint64(short))
                for j in range(short):
                    acc = K.chain(acc, hashes[words.first[texts] + j])
                keys.append(K.mix(acc))
                rows.append(texts)
        key, row = np.concatenate(keys), np.concatenate(rows)
        order = np.lexsort((key, row))
        key, row = key[order], row[order]
        new = np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]))[: len(key)]
        self.key, self.row = key[new], row[new]
        self.first = np.searchsorted(self.row, np.arange(n + 1))
        self.size = np.diff(self.first)
        # Digest of a set: two sums of hashed members.
        some = np.flatnonzero(self.size)
        low, high = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        if len(some):
            low[some] = np.add.reduceat(K.mix(self.key ^ K._A), self.first[some])
            high[some] = np.add.reduceat(K.mix(self.key ^ K._C), self.first[some])
        both = np.stack([K.mix(low), K.mix(high)], axis=1)
        self.digest = [both[i].tobytes() if s else None for i, s in enumerate(self.size)]

    def of(self, i: int) -> np.ndarray:
        return self.key[self.first[i] : self.first[i + 1]]


def document_sets(texts: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, v): size and digest of every row's set."""
    schema = T.StructType([texts.schema["doc_id"], *T.StructType.fromDDL("n long, v binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch.column(1)):
                sets = Sets(part, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[part.lo : part.hi],
                        pa.array(sets.size, pa.int64()),
                        pa.array(sets.digest, pa.binary()),
                    ],
                    schema.names,
                )

    return texts.mapInArrow(run, schema)


def token_frequencies(texts: DataFrame, width: int, bits: int, max_bytes: int) -> DataFrame:
    """By hash range: a filter of the tokens that two documents have, and a list of the frequent.

    Tokens count by the high 48 bits of their hash: it only matters that all documents see the
    same order. Copies inside one task count once.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, seen = 0, set()

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            rows = [
                (part, P.pack(keys[at])[: 6 * (at.stop - at.start)], P.pack(n[at].astype(np.uint32)))
                for part, at in P.ranges(keys << _48, bits)
            ]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "keys", "counts"]
            )

        for batch in batches:
            for part in K.slices(batch.column(0)):
                sets = Sets(part, width)
                fresh = np.zeros(len(sets.size), bool)
                for i, v in enumerate(sets.digest):
                    if v and v not in seen:
                        seen.add(v)
                        fresh[i] = True
                if len(seen) > 200_000:
                    seen.clear()
                held.append(sets.key[fresh[sets.row]] >> _48)
                size += len(held[-1])
                if size >= FLUSH:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    kinds = [pa.int32(), pa.binary(), pa.binary()]

    def merge(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        rows = zip(group.column("keys").to_pylist(), group.column("counts").to_pylist())
        pairs = [
            # The two highest planes were all zero and were left out.
            (P.unpack(k + bytes(len(k) // 3), "<u8"), P.unpack(n, np.uint32).astype(np.int64))
            for k, n in rows
        ]
        keys, n = P.summed(*(np.concatenate(x) for x in zip(*pairs)))
        shared = keys[n > 1]
        most = max(10, (max_bytes * 8 >> bits).bit_length() - 1)
        size = min(most, max(10, (16 * len(shared)).bit_length()))
        held = np.zeros(1 << size >> 3, np.uint8)
        _put(held, _probe(shared, size))
        listed = n >= LISTED_FROM
        level = np.minimum(np.log2(n[listed]).astype(np.uint8), 63)
        return pa.table(
            {
                "part": pa.array([part], pa.int32()),
                "bits": pa.array([size], pa.int32()),
                "held": pa.array([held.tobytes()], pa.binary()),
                "keys": pa.array([P.pack(keys[listed])], pa.binary()),
                "levels": pa.array([level.tobytes()], pa.binary()),
                "found": pa.array([np.bincount(level, minlength=64)], pa.list_(pa.int64())),
            }
        )

    sent = texts.select("text").mapInArrow(send, "part int, keys binary, counts binary")
    return sent.groupBy("part").applyInArrow(
        merge, "part int, bits int, held binary, keys binary, levels binary, found array<long>"
    )


def token_order(found: DataFrame, bits: int, most: int) -> dict:
    """What a task needs to order tokens: bounded filters and at most ``most`` listed tokens."""
    totals = found.select(F.posexplode("found").alias("level", "n")).groupBy("level")
    by_level = {r["level"]: r["s"] for r in totals.agg(F.sum("n").alias("s")).collect()}
    least, listed = 64, 0
    while least and listed + by_level.get(least - 1, 0) <= most:
        least -= 1
        listed += by_level.get(least, 0)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, levels = [], []
            for k, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                level = np.frombuffer(x, np.uint8)
                mine = level >= least
                keys.append(P.unpack(k, np.uint64)[mine].tobytes())
                levels.append(level[mine].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(levels, pa.binary())],
                ["part", "keys", "levels"],
            )

    rows = (
        found.select("part", "keys", "levels")
        .mapInArrow(keep, "part int, keys binary, levels binary")
        .collect()
    )
    rows.sort(key=lambda r: r["part"])
    return {
        "bits": bits,
        "filters": {r["part"]: (r["bits"], bytes(r["held"])) for r in found.select("part", "bits", "held").collect()},
        "keys": b"".join(bytes(r["keys"]) for r in rows),
        "levels": b"".join(bytes(r["levels"]) for r in rows),
    }


class Order:
    """Level of a token: 0 if one document has it, 1 if two or more, else from its count."""

    def __init__(self, table: dict):
        self.bits = table["bits"]
        self.filters = {p: (b, np.frombuffer(x, np.uint8)) for p, (b, x) in table["filters"].items()}
        self.keys = np.frombuffer(table["keys"], np.uint64)
        self.listed = np.frombuffer(table["levels"], np.uint8)

    def levels(self, tokens: np.ndarray) -> np.ndarray:
        keys, back = np.unique(tokens >> _48, return_inverse=True)
        level = np.zeros(len(keys), np.uint8)
        for part, at in P.ranges(keys << _48, self.bits):
            if part in self.filters:
                size, held = self.filters[part]
                level[at] = _holds(held, _probe(keys[at], size))
        if len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[place] == keys
            level[known] = self.listed[place[known]]
        return level[back]


def missable(size: np.ndarray, percent: int) -> np.ndarray:
    """How many of its tokens a set may lack in a set that it links with."""
    return size - -(-percent * size // 100)


def missable_by_smaller(size: np.ndarray, percent: int) -> np.ndarray:
    """How many of its tokens a set may lack in a set that is not smaller."""
    return size - -(-2 * percent * size // (100 + percent))


def signatures(
    token: np.ndarray, row: np.ndarray, size: np.ndarray, level: np.ndarray, percent: int, classes
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, signature, whether it also stands for the smaller role) of the prefixes.

    Tokens are in (row, hash) order, ``size`` is by row.
    """
    # Sets that no different set can link with have no signature.
    able = 100 * size >= percent * (size + 1)
    scale = np.zeros(len(size), np.int64)
    scale[size > 0] = np.floor(np.log2(size[size > 0])).astype(np.int64)
    out_rows, out, out_small = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
    k = np.ones(len(token), np.int64)
    for count, tokens in classes:
        k[level >= int(math.log2(count))] = tokens
    extra = sum(tokens - 1 for _, tokens in classes)
    for up in (0, 1):
        mine = able.copy()
        if up:  # also with the number of blocks of the next power of two, when close to it
            mine &= 100 * size >= percent * (np.int64(1) << (scale + 1))
        at = np.flatnonzero(mine[row])
        if not len(at):
            continue
        owner, key, kind = row[at], token[at], k[at]
        step = scale[owner] + up
        smallest = -(-percent * (np.int64(1) << step) // 100)
        # The blocks of all classes together leave out less than half of what sets must share.
        blocks = np.maximum(1, percent * smallest // (200 * max(1, extra) * np.maximum(1, kind - 1)))
        spread = K.mix(key ^ K._B)
        block = np.where(kind > 1, (spread % blocks.astype(np.uint64)).astype(np.int64), 0)
        inner = np.where(kind > 1, 0, level[at])
        order = np.lexsort((key, inner, block, kind, owner))
        owner, key, kind, block = owner[order], key[order], kind[order], block[order]
        one = level[at][order] == 0
        n = len(owner)
        new = np.append(
            True,
            (owner[1:] != owner[:-1]) | (kind[1:] != kind[:-1]) | (block[1:] != block[:-1]),
        )
        place = np.arange(n) - np.flatnonzero(new)[np.cumsum(new) - 1]
        counts = np.cumsum(place >= kind - 1)
        begin = np.append(True, owner[1:] != owner[:-1])
        counted = np.where(place >= kind - 1, 1, 0)
        base = (counts - counted)[np.flatnonzero(begin)][np.cumsum(begin) - 1]
        # In the prefix while what stands before counts at most what may be missing.
        before = counts - counted - base
        inside = before <= missable(size, percent)[owner]
        small = before <= missable_by_smaller(size, percent)[owner]
        tag = (step[order].astype(np.uint64) << np.uint64(8)) + kind.astype(np.uint64)
        single = np.flatnonzero(inside & (kind == 1) & ~one)
        out_rows.append(owner[single])
        out.append(K.mix(K.chain(key[single], tag[single])))
        out_small.append(small[single])
        for tokens in sorted({t for _, t in classes}):
            last = np.flatnonzero(inside & (kind == tokens))
            _combine(last, key[last], tokens, key, tag, place, owner, small, (out_rows, out, out_small))
    rows, found, small = np.concatenate(out_rows), np.concatenate(out), np.concatenate(out_small)
    order = np.lexsort((~small, found, rows))
    rows, found, small = rows[order], found[order], small[order]
    new = np.append(True, (rows[1:] != rows[:-1]) | (found[1:] != found[:-1]))[: len(rows)]
    return rows[new], found[new], small[new]


def _combine(last, acc, left, key, tag, place, owner, small, out, at=None) -> None:
    """Add each combination of tokens of a block that ends with one of ``last``."""
    at = last if at is None else at
    if left == 1:
        out[0].append(owner[last])
        out[1].append(K.mix(K.chain(acc, tag[last])))
        out[2].append(small[last])
        return
    back = 1
    while True:
        deep = place[at] >= back
        if not deep.any():
            return
        last, acc, at = last[deep], acc[deep], at[deep]
        _combine(last, K.chain(acc, key[at - back]), left - 1, key, tag, place, owner, small, out, at - back)
        back += 1


def indexed_sets(texts: DataFrame, order: dict, width: int, percent: int, classes) -> DataFrame:
    """Sets with a signature: v, n, own (tokens that no other set has), bitmap, signatures, tokens.

    Signatures of the smaller role come first, ``roles`` is their number. A task gives equal
    sets once.
    """
    shared = texts.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, seen = Order(shared.value), set()
        for batch in batches:
            for part in K.slices(batch.column(0)):
                sets = Sets(part, width)
                level = ranks.levels(sets.key)
                rows, found, small = signatures(
                    sets.key, sets.row, sets.size, level, percent, classes
                )
                order = np.lexsort((~small, rows))
                rows, found = rows[order], found[order]
                roles = np.bincount(rows[small[order]], minlength=len(sets.size))
                alone = np.bincount(sets.row[level == 0], minlength=len(sets.size))
                cut = np.searchsorted(rows, np.arange(len(sets.size) + 1))
                out = []
                for i in np.flatnonzero(np.diff(cut)):
                    v = sets.digest[i]
                    if v not in seen:
                        seen.add(v)
                        mine = found[cut[i] : cut[i + 1]].view(np.int64)
                        bits = bitmap(sets.of(i)).tolist()
                        tokens = P.pack(sets.of(i))
                        sizes = int(sets.size[i]), int(alone[i]), int(roles[i])
                        out.append((v, *sizes, *bits, mine, tokens))
                if len(seen) > 200_000:
                    seen.clear()
                kinds = [pa.binary()] + [pa.int64()] * (3 + len(_BITS))
                kinds += [pa.list_(pa.int64()), pa.binary()]
                columns = zip(*out) if out else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                    ["v", "n", "own", "roles", *_BITS, "signatures", "tokens"],
                )

    bits = ", ".join(f"{b} long" for b in _BITS)
    return texts.select("text").mapInArrow(
        run, f"v binary, n long, own long, roles long, {bits}, signatures array<long>, tokens binary"
    )


_BITS = tuple(f"b{i}" for i in range(8))


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """512 bits, each the parity of the tokens that fall on it: what differs in two sets' bitmaps
    differs in the sets."""
    places = (K.mix(tokens ^ K._A) & np.uint64(511)).astype(np.int64)
    odd = (np.bincount(places, minlength=512) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _other(meta: DataFrame) -> DataFrame:
    """``meta`` under the names of the second set of a pair."""
    return meta.withColumnsRenamed({c: f"w_{c}" for c in meta.columns if c != "v"}).withColumnRenamed(
        "v", "w"
    )


def may_link(percent: int):
    """Whether two sets can link by their sizes, own tokens and bitmaps. Exact in one direction."""
    n, m = F.col("n"), F.col("w_n")
    need = F.floor((percent * (n + m) + (100 + percent) - 1) / (100 + percent))
    apart = sum(
        (F.bit_count(F.col(b).bitwiseXOR(F.col(f"w_{b}"))) for b in _BITS), F.lit(0)
    )
    reach = F.least(n - F.col("own"), m - F.col("w_own"))
    return (reach >= need) & (apart <= n + m - 2 * need)


def best_partners(held: DataFrame, meta: DataFrame, percent: int) -> DataFrame:
    """(v, w): for each set the one that shares most signatures with it, of their hubs.

    The hub of a signature is its set with fewest tokens of its own: the likely origin of copies.
    """
    hub = F.min(F.struct("own", "v"))
    first = held.groupBy("s").agg(hub.alias("hub"), F.min("v").alias("low"), F.max("v").alias("top"))
    pairs = (
        held.join(first.filter("low <> top").select("s", F.col("hub.v").alias("w")), "s")
        .filter("v <> w")
        .groupBy("v", "w")
        .agg(F.count("*").alias("together"))
    )
    known = lookup_join(lookup_join(pairs, meta, ["v"], "inner"), _other(meta), ["w"], "inner")
    return (
        known.filter(may_link(percent))
        .groupBy("v")
        .agg(F.max_by("w", F.struct("together", "w")).alias("w"))
    )


def across_components(
    held: DataFrame, labels: DataFrame, meta: DataFrame, percent: int
) -> DataFrame:
    """(v, w) pairs of sets of different components that share a signature and may link.

    One side is in its smaller role there, the other is not smaller.
    """
    several = (
        held.groupBy("s").agg(F.min("v").alias("low"), F.max("v").alias("top")).filter("low <> top")
    )
    marked = held.select("s", "v", "small").join(several.select("s"), "s", "left_semi")
    marked = lookup_join(marked, labels, ["v"])
    marked = materialise(
        marked.select("s", "v", "small", F.coalesce("root", "v").alias("root")), "marked"
    )
    main = (
        marked.groupBy("s", "root")
        .agg(F.count("*").alias("n"))
        .groupBy("s")
        .agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots"))
        .filter("roots > 1")
        .drop("roots")
    )
    open_ = lookup_join(marked.join(main, "s"), meta, ["v"], "inner")
    open_ = materialise(open_, "open")
    ordered = "root <> other AND (n < w_n OR n = w_n AND v < w)"

    def pairs(low: DataFrame, high: DataFrame) -> DataFrame:
        high = _other(high.drop("main", "small")).withColumnsRenamed({"w_s": "s", "w_root": "other"})
        return low.join(high, "s").filter(F.expr(ordered) & may_link(percent)).select("v", "w")

    # Each pair has a side outside the signature's main component: the smaller one or the larger.
    small, beside = open_.filter("small"), F.expr("root <> main")
    both = pairs(small.filter(beside), open_).unionByName(pairs(small.filter(~beside), open_.filter(beside)))
    return both.distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs (v, w) that link, by their whole sets."""
    one = sets.select("v", "tokens")
    two = sets.select(F.col("v").alias("w"), F.col("tokens").alias("others"))
    both = pairs.select("v", "w").join(one, "v").join(two, "w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                mine, theirs = P.unpack(x.as_py(), np.uint64), P.unpack(y.as_py(), np.uint64)
                common = len(np.intersect1d(mine, theirs, assume_unique=True))
                good.append(100 * common >= percent * (len(mine) + len(theirs) - common))
            kept = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(kept), batch.column(1).filter(kept)], ["a", "b"]
            )

    return both.select("v", "w", "tokens", "others").mapInArrow(run, "a binary, b binary")


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    words: int = WORDS,
    percent: int = PERCENT,
    classes=CLASSES,
    max_listed: int = MAX_LISTED,
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    spark = docs.sparkSession
    texts = text_of(docs, id_col, text_col)
    bits = P.range_bits(spark, 1)
    own = materialise(document_sets(texts, words), "sets")
    found = materialise(token_frequencies(texts, words, bits, max_filter_bytes), "tokens")
    order = token_order(found, bits, max_listed)
    indexed = materialise(indexed_sets(texts, order, words, percent, classes), "indexed")
    sets = indexed.select("v", "tokens").dropDuplicates(["v"])
    meta = indexed.select("v", "n", "own", *_BITS).dropDuplicates(["v"])
    meta = materialise(meta, "set-bitmaps")
    held = indexed.select("v", "own", "roles", F.posexplode("signatures").alias("at", "s"))
    held = held.select("v", "own", "s", (F.col("at") < F.col("roles")).alias("small"))
    held = materialise(held.dropDuplicates(["s", "v"]), "signatures")
    links = materialise(verified(best_partners(held, meta, percent), sets, percent), "first-links")
    labels = components(links)
    more = across_components(held, labels, meta, percent)
    more = materialise(verified(more, sets, percent), "more-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    smallest = own.filter("v IS NOT NULL").groupBy("v").agg(F.min("doc_id").alias("least"))
    rooted = lookup_join(smallest, labels, ["v"]).select(
        "v", "least", F.coalesce("root", "v").alias("root")
    )
    rooted = materialise(rooted, "rooted")
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_set = materialise(
        lookup_join(rooted, of_root, ["root"]).select("v", "component_id"), "component-ids"
    )
    return lookup_join(own, of_set, ["v"]).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("v").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
