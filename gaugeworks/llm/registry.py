"""One query per operator on the given tables, with production parameters, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import kneser_ney, licence_sentences, quality_classifier
from gaugeworks.llm.best_fit_packing import best_fit_packing
from gaugeworks.llm.decontaminate import decontaminate
from gaugeworks.llm.importance_resampling import importance_resample
from gaugeworks.llm.line_bloom import line_dedup
from gaugeworks.llm.ngram_jaccard import jaccard_components
from gaugeworks.llm.periodic_runs import collapse_runs
from gaugeworks.llm.quality_bands import compression_bands
from gaugeworks.llm.recompression import repeats
from gaugeworks.llm.url_filter import url_filter
from gaugeworks.llm.warc import read_warc, write_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(job):
        QUERIES[job.__name__] = job
        if sql is not None:
            SQL[job.__name__] = sql
        return job

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_bands(table(spark, sf_dir, "documents").select("doc_id", "text")).drop(
        "text"
    )


#: The rules of the url query, longest match wins.
URL_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)


@query()
def op2_host_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, URL_RULES, table(spark, sf_dir, "documents").select("text"))


OP3_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), f AS (
  SELECT k FROM s GROUP BY k HAVING count(*) > 1
), t AS (
  SELECT s.doc_id, s.k FROM s JOIN f USING (k)
), pair AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
  FROM t x JOIN t y ON x.k = y.k AND x.doc_id <> y.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM pair JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * o >= 90 * (p.n + q.n - o)
), walk(doc_id, here) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT walk.doc_id, link.b FROM walk JOIN link ON link.a = walk.here
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(here) AS component_id FROM walk GROUP BY doc_id) c USING (doc_id)
"""


@query(OP3_SQL)
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP4_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
), late AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS m FROM win) WHERE m < doc_id
), hit AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM late
), word AS (
  SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d
), kept AS (
  SELECT w.doc_id, count(h.p) AS n_removed,
    string_agg(w.x, ' ' ORDER BY w.p) FILTER (WHERE h.p IS NULL) AS t
  FROM word w LEFT JOIN hit h ON h.doc_id = w.doc_id AND h.p = w.p GROUP BY w.doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
  sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)
"""


@query(OP4_SQL)
def op4_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@query(licence_sentences.oracle_sql())
def op5_licence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licence_sentences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lists = ("sentence_ids", "licences", "left_over")
    return found.withColumns({c: F.array_join(c, ",") for c in lists})


OP6_SQL = """
WITH line AS (
  SELECT doc_id, i, l, translate(regexp_replace(l, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
        FROM documents)
), repeated AS (
  SELECT k, max(doc_id) AS keeper FROM line WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT l.doc_id, count(*) AS n_lines,
  count(*) FILTER (WHERE r.k IS NOT NULL AND l.doc_id <> r.keeper) AS n_dropped,
  sha256(coalesce(string_agg(l.l, chr(10) ORDER BY l.i)
    FILTER (WHERE r.k IS NULL OR l.doc_id = r.keeper), '')) AS kept_sha256
FROM line l LEFT JOIN repeated r ON r.k = l.k
GROUP BY l.doc_id
"""


@query(OP6_SQL)
def op6_line_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit("")).cast("binary")
    return line_dedup(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256")
    )


@query()
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


@query()
def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", kneser_ney.held_out(F.col("doc_id")))
    model = kneser_ney.train(docs.filter(~F.col("held_out")))
    return kneser_ney.score(docs, model).drop("text")


OP9_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@query(OP9_SQL)
def op9_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_warc(table(spark, sf_dir, "pages"))
    return read_warc(index, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP10_SQL = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM item WHERE len(w) > 0)
), found AS (
  SELECT s.doc_id, s.i, s.size, x.item_id
  FROM (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS k
        FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
              FROM words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)) s
  JOIN windows x ON x.size = s.size AND x.k = s.k
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words,
  CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM words d LEFT JOIN hit h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""


@query(OP10_SQL)
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def _crc_of_id() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def with_planted_period(docs: DataFrame) -> DataFrame:
    """``docs`` whose texts repeat from some word on, for one id in ten, as the query asks."""
    crc = _crc_of_id()
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    found = docs.withColumn("__w", F.when(crc % 10 == 0, words))
    found = found.withColumn("__n", F.size("__w")).withColumn("__a", F.floor(crc / 10) % F.col("__n"))
    ahead = F.col("__n") - F.col("__a")
    found = found.withColumn("__p", 1 + F.floor(ahead / (3 + F.floor(crc / 10) % 8)))
    a, p, n = (F.col(c).cast("int") for c in ("__a", "__p", "__n"))
    cycle = F.slice("__w", a + 1, p)
    again = F.flatten(F.array_repeat(cycle, F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.slice(F.concat(F.slice("__w", F.lit(1), a), again), F.lit(1), n), " ")
    # No words: the size is -1 (null) or 0, and the text stays.
    text = F.when(F.col("__n") > 0, planted).otherwise(F.col("text"))
    return found.withColumn("text", text).drop("__w", "__n", "__a", "__p")


@query()
def op11_block_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = collapse_runs(with_planted_period(docs))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    listed = F.array_join(F.transform("runs", line), "")
    best = F.col("best")
    return found.select(
        "doc_id",
        "n_runs",
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query()
def op12_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", F.coalesce(_crc_of_id() % 3 == 1, F.lit(False)))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality_classifier.train(docs.filter(~F.col("held_out")), labels)
    return quality_classifier.classify(docs, model).drop("text")


_LOWER_WORDS = (
    "coalesce(regexp_extract_all("
    "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"
)
#: 3988292384 is the reversed polynomial of CRC-32; features are hashed once each.
OP13_SQL = f"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))
), d AS (
  SELECT doc_id, {_LOWER_WORDS} AS w FROM documents
), b AS (
  SELECT {_LOWER_WORDS} AS w FROM benchmark
), feature AS (
  SELECT doc_id, unnest(w) AS f FROM d
  UNION ALL SELECT doc_id, w[i] || ' ' || w[i + 1]
  FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)
), sought AS (
  SELECT unnest(w) AS f FROM b
  UNION ALL SELECT w[i] || ' ' || w[i + 1] FROM (SELECT w, unnest(range(1, len(w))) AS i FROM b)
), bucketed AS (
  SELECT f, xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i: CAST(
        instr('0123456789ABCDEF', x[i]) * 16 + instr('0123456789ABCDEF', x[i + 1]) - 17 AS BIGINT))),
      lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]))) % 10000 AS k
  FROM (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM feature UNION SELECT f FROM sought)), crc_table
), source AS (
  SELECT k, count(*) AS s FROM feature JOIN bucketed USING (f) GROUP BY k
), target AS (
  SELECT k, count(*) AS t FROM sought JOIN bucketed USING (f) GROUP BY k
), gain AS (
  SELECT k, CAST(floor(1000 * ln(
      (coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM feature) + 10000)
      / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM sought) + 10000)))) AS BIGINT) AS g
  FROM source FULL JOIN target USING (k)
), weighed AS (
  SELECT doc_id, count(*) AS n, sum(g) AS total
  FROM feature JOIN bucketed USING (f) JOIN gain USING (k) GROUP BY doc_id
), noise AS (
  SELECT doc_id, len(w) AS n_words,
    (CAST('0x' || sha256('7:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS u
  FROM d
), scored AS (
  SELECT doc_id, n_words, coalesce(n, 0) AS n_features,
    CAST(coalesce((total - ((total % n) + n) % n) // n, 0) AS BIGINT) AS weight,
    CAST(floor(-1000.0::DOUBLE * ln(-ln(u))) AS BIGINT) AS g
  FROM noise LEFT JOIN weighed USING (doc_id)
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY weight + g DESC, doc_id) AS r,
    25 * count(*) OVER () // 100 AS most
  FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, weight + g AS score, CASE WHEN r <= most THEN r END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""


@query(OP13_SQL)
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = importance_resample(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
