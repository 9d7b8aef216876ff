"""Queries on streams that stop, start again and share a target, with their SQL twins."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gaugeworks.functions import strip
from gaugeworks.plans import adapters as A
from gaugeworks.plans import registry as R
from gaugeworks.session import fresh_path, remove_path
from gaugeworks.sinks.files import messages
from gaugeworks.sources import decode_events, flatten_payload, json_file_stream
from gaugeworks.sources.message_log import append_messages, message_log_stream
from gaugeworks.sources.tables import register_views
from gaugeworks.streaming.progress import ProgressLog, read_progress, runs
from gaugeworks.streaming import committed_batches, enrich_messages, keep_running, load_clean_keyed, read_committed

query = R.query

# Kinds of events that arrive one after the other; the second arrival stops half way.
_ARRIVALS = (("view", "click"), ("purchase", "signup"), ("error",))


def _kinds(arrivals) -> str:
    return "event_type IN (" + ", ".join(f"'{k}'" for kinds in arrivals for k in kinds) + ")"


def _visible(step: int, arrived: int) -> str:
    return (
        f"SELECT {step} AS step, count(*) AS raw, count(*) FILTER (WHERE NOT ({R._NO_SITE})) AS enriched"
        f" FROM delivered WHERE {_kinds(_ARRIVALS[:arrived])}"
    )


@query(" UNION ALL ".join(_visible(*x) for x in ((1, 1), (2, 1), (3, 3))), ("delivered",))
def stream_committed(spark, sf):
    """What readers see after a batch, after one that stops between two outputs, and after its repeat."""
    rows = A.delivered(spark, sf)
    inbox, out = fresh_path(spark, "messages"), fresh_path(spark, "stream")
    sites = R._stream_sites(spark, sf)
    seen = []

    def run(broken=None):
        def after(name, batch_id):
            if name == broken:
                raise RuntimeError("stopped between two outputs")

        stream = json_file_stream(spark, inbox)
        started = enrich_messages(stream, sites, out, f"{out}/checkpoint", after_output=after)
        try:
            started.awaitTermination()
        except StreamingQueryException:
            if not broken:
                raise
        raw = read_committed(spark, out, "raw", "value STRING", "text")
        enriched = read_committed(spark, out, "enriched", "event_id STRING")
        seen.append((len(seen) + 1, raw.count(), enriched.count()))

    for kinds, broken in zip(_ARRIVALS, (None, "enriched", None)):
        some = A.project(rows.filter(_kinds([kinds])), R._STREAMED)
        messages(some).write.mode("append").text(inbox)
        run(broken)
    return spark.createDataFrame(seen, "step int, raw long, enriched long")


@query(R._LOADED_EVENTS, R._STREAM_VIEWS)
def stream_load_reset(spark, sf):
    """A load whose checkpoint is cleared half way starts over and loses nothing that was loaded."""
    out, target = R._run_enrich(spark, sf), fresh_path(spark, "clean")
    R._load(spark, out, target, f"{target}-checkpoint", "[01]")
    remove_path(spark, f"{target}-checkpoint")
    R._load(spark, out, target, f"{target}-checkpoint")
    return R._loaded(spark, target)


@query(R._LOADED_EVENTS, R._STREAM_VIEWS)
def stream_load_stateful(spark, sf):
    """The load with the loaded ids in keyed state, in ten batches, all enriched rows twice."""
    out, target = R._run_enrich(spark, sf), fresh_path(spark, "clean")
    inbox = fresh_path(spark, "enriched-twice")
    enriched = spark.read.parquet(f"{out}/enriched").drop("query_id", "batch_id")
    # Ten batches of two files for each task that a batch may have.
    most = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")) // 10)
    for _ in range(2):
        enriched.repartition(10 * most).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(enriched.schema).option("maxFilesPerTrigger", 2 * most).parquet(inbox)
    load_clean_keyed(stream, target, f"{target}-checkpoint", run_at=R.RUN_AT).awaitTermination()
    batches = committed_batches(spark, target).count()
    assert batches == 10, batches
    return R._loaded(spark, target)


@query(
    f"SELECT *, 2 AS failures FROM ({R._LOADED_EVENTS.strip()})", R._STREAM_VIEWS
)
def stream_restarted(spark, sf):
    """An enriching stream that fails twice and is started again from its checkpoint, then loaded."""
    out, target = fresh_path(spark, "stream"), fresh_path(spark, "clean")
    stream, sites, failed = R._streamed_messages(spark, sf), R._stream_sites(spark, sf), []

    def after(name, batch_id):
        if (name, batch_id) in (("raw", 1), ("rejected", 2)) and batch_id not in failed:
            failed.append(batch_id)
            raise RuntimeError("not yet")

    def start():
        return enrich_messages(stream, sites, out, f"{out}/checkpoint", after_output=after)

    failures = keep_running(start, pause_seconds=0)
    R._load(spark, out, target, f"{target}-checkpoint")
    return R._loaded(spark, target).withColumn("failures", F.lit(failures))


@query(
    """SELECT count(*) AS n, count(*) AS distinct_ids, count(*) AS well_formed, count(*) AS just_now
       FROM events"""
)
def payload_defaults(spark, sf):
    """Events from responses without an id and a time of their own: both are filled in."""
    body = F.to_json(F.struct(F.struct(F.col("value").alias("temperature_2m")).alias("current")))
    responses = A.table(spark, sf, "events").select(body.alias("body"))
    flat = flatten_payload(responses, "body", latitude=44.8378, longitude=-0.5792, source="open-meteo")
    hexes = "^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$"
    age = F.unix_seconds(F.current_timestamp()) - F.unix_seconds(F.col("collected_at").cast("timestamp"))
    return flat.agg(
        F.count("*").alias("n"),
        F.countDistinct("event_id").alias("distinct_ids"),
        F.count_if(F.col("event_id").rlike(hexes)).alias("well_formed"),
        F.count_if(age.between(-5, 3600)).alias("just_now"),
    )


_ZONE_SITES = """SELECT zone_code, count(*) AS sites, count(DISTINCT e.event_id) AS events FROM sites s
    JOIN places e ON e.gid = s.gid GROUP BY zone_code"""


@query(
    "SELECT * FROM (WITH sites AS (SELECT * FROM short_sites), places AS (SELECT event_id,"
    f" CAST(user_id AS INT) AS gid FROM events) {_ZONE_SITES})",
    ("short_sites",),
)
def views_sql(spark, sf):
    """Plain SQL over registered views."""
    places = A.table(spark, sf, "events").selectExpr("event_id", "CAST(user_id AS INT) AS gid")
    sites = A.short_sites(spark, sf).withColumn("ident", strip("ident"))
    register_views({"sites": sites, "places": places})
    return spark.sql(_ZONE_SITES)


@query(
    """SELECT 'ended' AS outcome, 4 AS batches, count(*) AS input_rows, 0 AS errors FROM delivered
       UNION ALL SELECT 'failed', 0, 0, 1""",
    ("delivered",),
)
def stream_progress(spark, sf):
    """What a listener has landed of a run that ends well and of one that fails in its first batch."""
    path = fresh_path(spark, "progress")
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        for broken in (False, True):

            def after(name, batch_id, broken=broken):
                if broken:
                    raise RuntimeError("no disk")

            out = fresh_path(spark, "stream")
            started = enrich_messages(
                R._streamed_messages(spark, sf), R._stream_sites(spark, sf), out, f"{out}/checkpoint", after_output=after
            )
            try:
                started.awaitTermination()
            except StreamingQueryException:
                if not broken:
                    raise
            log.wait(started)
    finally:
        spark.streams.removeListener(log)
    progress = read_progress(spark, path)
    errors = progress.groupBy("run_id").agg(F.count("error").alias("errors"))
    return runs(progress).join(errors, "run_id").select("outcome", "batches", "input_rows", "errors")


@query(
    f"""SELECT {A.LANDED["event_id"]} AS event_id, value AS temperature_c, 4 AS partitions, true AS offsets_whole
        FROM delivered""",
    ("delivered",),
)
def stream_source_offsets(spark, sf):
    """A partitioned log that is appended to between two runs of a query: each message arrives once."""
    root, out = fresh_path(spark, "log"), fresh_path(spark, "from-log")
    rows = A.delivered(spark, sf)

    def run(kinds):
        some = A.project(rows.filter(_kinds([kinds])), R._STREAMED)
        append_messages(messages(some), root, 4, key=F.get_json_object("value", "$.event_id"))
        stream = message_log_stream(spark, root)
        writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()

    for kinds in _ARRIVALS:
        run(kinds)
    landed = spark.read.parquet(out)
    ends = landed.groupBy("partition").agg(F.count("*").alias("n"), F.countDistinct("offset").alias("d"), F.max("offset").alias("m"))
    whole = ends.agg(F.count("*"), F.min((F.col("n") == F.col("d")) & (F.col("m") + 1 == F.col("n")))).first()
    return decode_events(landed.select("value")).select(
        "event_id", "temperature_c", F.lit(whole[0]).cast("int").alias("partitions"), F.lit(whole[1]).alias("offsets_whole")
    )
