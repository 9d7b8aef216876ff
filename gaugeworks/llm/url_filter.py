"""URL filter: host and path rules first, then naive Bayes over segmented host and path tokens.

Rules name a host, for itself and all subdomains, and the beginning of a path; the longest rule
that fits decides. Urls without a rule are scored by a multinomial naive Bayes model. Its tokens
are the words of the host, found in concatenated names by a unigram Viterbi split, and the words
of the path. Numbers count by their number of digits.

Everything is counted over all rows. Word counts come from a corpus of texts, and only words that
occur inside a host label are kept, by a join on their hash. Each different host label is split
once; each different (host, path) is scored once. Training urls are given with their class, or
else are those that a rule decides: the model then carries the rules' judgement over to hosts and
paths that no rule names. Joins on host, token and (host, path) go through ``lookup_join``, which
splits hot keys.

Null url or no ``://``: host and path are empty, no rule fits, the score is the prior's. Ties
(score 0) and a training set with one class only: allow, unless all training urls are blocked.
Rules of equal length cannot both fit one url unless equal; the smaller text wins then. Repeated
rows and ids are judged each by itself; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm import tokens as K
from gaugeworks.operators.lookup import lookup_join
from gaugeworks.session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONGEST_WORD = 24
SMOOTHING = 1.0
FLUSH_WORDS = 1_000_000
_NOT_LETTER = K.byte_class(bytes(b for b in range(256) if not 97 <= b <= 122))


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_rules(hosts: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``hosts`` with the rules whose host fits, longest first: (rule, path, verdict)."""
    spark = hosts.sparkSession
    rows = [(r, r.partition("/")[0], "/" + r.partition("/")[2], v) for r, v in rules]
    table = spark.createDataFrame(rows, "rule string, suffix string, path string, verdict string")
    deepest = max([x[1].count(".") + 1 for x in rows], default=1)
    # The last 1, 2, .. labels of the host, as many as any rule has.
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(deepest)),
        lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n),
    )
    fitting = (
        hosts.select("host", F.explode(F.array_distinct(ends)).alias("suffix"))
        .join(F.broadcast(table) if len(rows) <= 100_000 else table, "suffix")
        .groupBy("host")
        .agg(
            F.sort_array(
                F.collect_list(F.struct(-F.length("rule"), "rule", "path", "verdict"))
            ).alias("rules")
        )
    )
    return hosts.join(fitting, "host", "left")


def ruling(rules: Column, path: Column) -> Column:
    """The longest rule whose path the url's path starts with, or null."""
    return F.get(F.filter(rules, lambda r: path.startswith(r["path"])), 0)


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, n): how often each lower-cased run of a-z occurs in a column of texts, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush():
            keys = np.concatenate([k for k, _ in held])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], np.concatenate([c for _, c in held])[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys[first].view(np.int64)), pa.array(np.add.reduceat(n, first))],
                ["h", "n"],
            )

        for batch in batches:
            for part in K.slices(batch.column(0)):
                data = K.LOWER[part.data]
                words = K.find_words(data, part.offsets, _NOT_LETTER)
                short = words.end - words.start <= LONGEST_WORD
                hashes = K.hash_words(data, words.start[short], words.end[short])
                if len(hashes):
                    held.append(np.unique(hashes, return_counts=True))
                    size += len(held[-1][0])
                if size >= FLUSH_WORDS:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    return texts.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def split_label(label: str, counts: dict[tuple[int, int], int], total: float) -> list[str]:
    """Most probable split of a run of letters; unseen pieces cost more the longer they are."""
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(label)
    for end in range(1, len(label) + 1):
        for start in range(max(0, end - LONGEST_WORD), end):
            n = counts.get((start, end))
            # An unseen word of k letters: ten in the corpus, less by ten for each letter.
            log = math.log(n / total) if n else math.log(10.0 / total) - (end - start) * math.log(10)
            score = best[start][0] + log
            if score > best[end][0]:
                best[end] = (score, start)
    out: list[str] = []
    end = len(label)
    while end:
        out.append(label[best[end][1] : end])
        end = best[end][1]
    return out[::-1]


def _pieces(labels: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(label, start, end, hash) of every piece of up to ``LONGEST_WORD`` letters, in bounded parts."""
    for part in K.slices(labels, limit=FLUSH_WORDS // LONGEST_WORD):
        size = np.diff(part.offsets)
        stop = np.repeat(part.offsets[1:], size)
        owner = np.repeat(np.arange(len(size)), size)
        # A long label is a slice of its own: its letters go in parts, too.
        for low in range(0, len(part.data), FLUSH_WORDS // LONGEST_WORD):
            at = np.arange(low, min(low + FLUSH_WORDS // LONGEST_WORD, len(part.data)))
            start = np.repeat(at, LONGEST_WORD)
            end = start + np.tile(np.arange(1, LONGEST_WORD + 1), len(at))
            fits = end <= stop[start]
            start, end = start[fits], end[fits]
            of, first = owner[start], part.offsets[owner[start]]
            yield part.lo + of, start - first, end - first, K.hash_words(part.data, start, end)


def segment_labels(labels: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(label, words) of distinct runs of letters.

    Pieces carry the number of their label and not its text, so a label of n letters costs
    ``LONGEST_WORD`` narrow rows a letter.
    """
    numbered = materialise(
        labels.select("label", F.monotonically_increasing_id().alias("number")), "host-labels"
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(1).to_numpy()
            for of, start, end, hashes in _pieces(batch.column(0)):
                columns = (number[of], start.astype(np.int32), end.astype(np.int32), hashes.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["number", "s", "e", "h"])

    spans = numbered.select("label", "number").mapInArrow(pieces, "number long, s int, e int, h long")
    known = (
        counts.join(spans, "h")
        .groupBy("number")
        .agg(F.collect_list(F.struct("s", "e", "n")).alias("known"))
    )
    total = float(max(total, 1))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one label at a time: some are very long
                label = batch.column(0)[i].as_py()
                found = {(x["s"], x["e"]): x["n"] for x in batch.column(1)[i].as_py() or ()}
                words = pa.array([split_label(label, found, total)], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), words], ["label", "words"])

    joined = numbered.join(known, "number", "left").select("label", "known")
    return joined.mapInArrow(split, "label string, words array<string>")


def _runs(text: Column) -> Column:
    """Runs of letters and of digits; digits count by their number."""
    runs = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit("([a-z]+|[0-9]+)"), F.lit(1))
    is_number = lambda x: x.substr(1, 1).between("0", "9")
    return F.transform(
        runs, lambda x: F.when(is_number(x), F.concat(F.lit("#"), F.length(x))).otherwise(x)
    )


def host_tokens(hosts: DataFrame, corpus: DataFrame | None) -> DataFrame:
    """(host, tokens): the words of each host, in order."""
    runs = hosts.select("host", F.posexplode(_runs(F.col("host"))).alias("at", "label"))
    labels = runs.filter(~F.col("label").startswith("#")).select("label").distinct()
    if corpus is None:
        corpus = labels
    counts = materialise(word_counts(corpus), "word-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    words = materialise(segment_labels(labels, counts, total), "host-words")
    split = runs.join(words, "label", "left").select(
        "host", "at", F.coalesce("words", F.array("label")).alias("words")
    )
    return split.groupBy("host").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("tokens")
    )


def token_odds(tokens: DataFrame, smoothing: float) -> tuple[float, DataFrame]:
    """(log odds of the classes, (token, odds)) from rows of tokens, n urls and blocked urls."""
    n, blocked = tokens.agg(F.sum("n"), F.sum("blocked")).first()
    n, blocked = n or 0, blocked or 0
    by_token = materialise(
        tokens.select(F.explode("tokens").alias("token"), "n", "blocked")
        .groupBy("token")
        .agg(F.sum(F.col("n") - F.col("blocked")).alias("good"), F.sum("blocked").alias("bad")),
        "url-tokens",
    )
    vocabulary, good, bad = by_token.agg(F.count("*"), F.sum("good"), F.sum("bad")).first()
    if not blocked or blocked == n:
        return (1.0 if n and blocked == n else -1.0), by_token.select(
            "token", F.lit(0.0).alias("odds")
        )
    room = smoothing * vocabulary
    odds = F.log((F.col("bad") + smoothing) / (bad + room)) - F.log(
        (F.col("good") + smoothing) / (good + room)
    )
    return math.log(blocked / (n - blocked)), by_token.select("token", odds.alias("odds"))


def url_filter(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    corpus: DataFrame | None = None,
    training: DataFrame | None = None,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row.

    ``rules`` holds (host/path, allow or block); ``corpus`` one column of texts for word counts;
    ``training`` (url, blocked) rows, by default the urls that a rule decides.
    """
    urls = pages.select(
        F.col(id_col).alias("page_id"),
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
    )
    # One row per different (host, path): all that follows works on these.
    places = materialise(urls.groupBy("host", "path").agg(F.count("*").alias("n")), "url-places")
    learned = None
    if training is not None:
        learned = training.select(
            host_of(F.col("url")).alias("host"),
            path_of(F.col("url")).alias("path"),
            F.col("blocked").cast("boolean").cast("bigint").alias("blocked"),
        )
    hosts = places.select("host")
    if learned is not None:
        hosts = hosts.unionByName(learned.select("host"))
    hosts = hosts.distinct()
    about = materialise(
        host_rules(hosts, rules).join(host_tokens(hosts, corpus), "host", "left"), "url-hosts"
    )

    def described(rows: DataFrame) -> DataFrame:
        tokens = F.concat(
            F.transform(F.coalesce("tokens", F.array().cast("array<string>")), lambda t: F.concat(F.lit("h:"), t)),
            F.transform(_runs(F.col("path")), lambda t: F.concat(F.lit("p:"), t)),
        )
        return lookup_join(rows, about, ["host"]).withColumns(
            {"tokens": tokens, "found": ruling(F.col("rules"), F.col("path"))}
        )

    known = materialise(
        described(places).select("host", "path", "n", "tokens", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("ruled")),
        "url-described",
    )
    if learned is None:
        taught = known.filter("ruled IS NOT NULL").select(
            "tokens", "n", F.when(F.col("ruled") == "block", F.col("n")).otherwise(0).alias("blocked")
        )
    else:
        taught = described(learned).select("tokens", F.lit(1).alias("n"), "blocked")
    prior, odds = token_odds(taught, smoothing)
    scored = (
        lookup_join(
            known.filter("ruled IS NULL").select("host", "path", F.explode("tokens").alias("token")),
            odds,
            ["token"],
            "inner",
        )
        .groupBy("host", "path")
        .agg(F.sum("odds").alias("odds"))
    )
    score = F.round(F.lit(prior) + F.coalesce("odds", F.lit(0.0)), 6)
    judged = known.join(scored, ["host", "path"], "left").select(
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(score > 0, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("ruled").isNull(), score).alias("score"),
    )
    return lookup_join(urls, materialise(judged, "url-judged"), ["host", "path"]).select(
        "page_id", "host", "path", "rule", "verdict", "score"
    )
