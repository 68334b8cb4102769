"""Queries of committed tables, streams that arrive in parts, and what follows from them, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions import clock
from framelake.operators import dictionary
from framelake.plans import incremental
from framelake.plans.catalog import DAY, EV, query
from framelake.shared import shared_path
from framelake.sources import lake, splits
from framelake.sources.tables import event_messages, table
from framelake.streaming import arrivals, keyed, sessions

PARTS = 4
REQUIRED = ["click", "view"]

# --- committed tables


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_returnflag FROM lineitem")
def committed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines, appended to a committed table in three writes, the first of which is written over again."""
    root = shared_path(spark, "lines")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag")
    third = F.pmod(F.xxhash64("l_orderkey"), F.lit(3))
    for k in (0, 0, 1, 2):
        lake.append(lines.where(third == k), root, replace=k == 0)
    return lake.load(spark, root)


@query("SELECT o_orderkey % 40 AS episode, count(*) AS rows FROM orders GROUP BY 1")
def committed_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as frames of forty episodes, written in two commits: rows of each episode's one file, as the commits state them."""
    root = shared_path(spark, "episodes")
    frames = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 40).alias("episode_index"), F.col("o_orderkey").alias("frame_index"), "o_totalprice")
    for k in (0, 1):
        lake.append_episodes(frames.where(F.col("episode_index") % 2 == k), root)
    return lake.files(spark, root).select("episode", "rows")


# --- streams


def _arriving(spark: SparkSession, sf_dir: str, late: bool) -> list[DataFrame]:
    """All events in parts by id; with late, each eleventh comes a part behind the others of its time."""
    own = event_messages(spark, sf_dir).withColumn("feature", F.col("topic")).select("source", "feature", "seq", "log_time_ns", "data")
    n = own.count()
    part = F.floor(F.col("seq") * PARTS / F.lit(n)) + (F.when(F.col("seq") % 11 == 0, 1).otherwise(0) if late else F.lit(0))
    dealt = own.withColumn("part", F.least(part, F.lit(PARTS - 1)))
    return [*[dealt.where(F.col("part") == k).drop("part") for k in range(PARTS)], keyed.ends(own)]


def _aligned(parts: list[DataFrame], required: list[str]) -> DataFrame:
    """Frames and late rows of the keyed aligner, whose query is stopped and started again behind each part, from a committed table."""
    spark = parts[0].sparkSession
    root = shared_path(spark, "aligned")

    def start(stream: DataFrame, notes: str):
        return keyed.with_state(lake.stream_into(keyed.aligned(stream, 0, required, interval=DAY), root, notes).trigger(availableNow=True))

    arrivals.run_in_parts(parts, start)
    return lake.load(spark, root)


_ARRIVED = f"""{EV}, n AS (SELECT count(*) AS n FROM events),
e AS (SELECT ev.*, ns // {DAY} * {DAY} AS b, least({PARTS - 1}, seq * {PARTS} // n + CASE WHEN seq % 11 = 0 THEN 1 ELSE 0 END) AS p FROM ev, n),
tops AS (SELECT source, p, max(max(ns)) OVER (PARTITION BY source ORDER BY p) AS upto, max(max(ns)) OVER (PARTITION BY source ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM e GROUP BY source, p),
r AS (SELECT e.*, coalesce(b + {3 * DAY} <= before, false) AS closed FROM e JOIN tops USING (source, p)),
seen AS (SELECT source, b, min(p) AS first, greatest(min(p) FILTER (topic = 'click'), CASE WHEN count(*) FILTER (topic = 'view') = 0 THEN NULL ELSE min(p) FILTER (topic = 'view') END) AS v,
  count(*) FILTER (topic = 'click') > 0 AND count(*) FILTER (topic = 'view') > 0 AS has FROM r WHERE NOT closed GROUP BY source, b),
g AS (SELECT s.source, s.b, CASE WHEN any_value(has) THEN any_value(v) ELSE 99 END AS complete, coalesce(min(t.p) FILTER (t.p >= s.first AND t.upto >= s.b + {3 * DAY}), {PARTS}) AS shut
  FROM seen s JOIN tops t ON s.source = t.source GROUP BY s.source, s.b),
w AS (SELECT r.*, closed OR p > least(complete, shut) AS late, complete <= shut AS whole FROM r LEFT JOIN g USING (source, b))"""


@query(f"""WITH {_ARRIVED}
SELECT 'late' AS kind, source, b AS bucket_ns, 1 AS n_messages, topic AS features, false AS complete, seq FROM w WHERE late
UNION ALL SELECT 'frame', source, b, count(*), string_agg(DISTINCT topic, ',' ORDER BY topic), any_value(whole), NULL FROM w WHERE NOT late GROUP BY source, b""")
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, some of them out of order: the keyed aligner's frames, and the rows that came when their frame had left."""
    found = _aligned(_arriving(spark, sf_dir, True), REQUIRED)
    return found.select("kind", "source", "bucket_ns", "n_messages", F.array_join("features", ",").alias("features"), "complete", "seq")


@query(f"""WITH {_ARRIVED}
SELECT source, topic, count(*) AS n, count(*) FILTER (late) AS n_late FROM w GROUP BY source, topic""")
def late_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of each source and topic, and how many of them were late: counts of late rows, joined back."""
    late = _aligned(_arriving(spark, sf_dir, True), REQUIRED).where("kind = 'late'").groupBy("source", F.col("features")[0].alias("topic")).agg(F.count("*").alias("n_late"))
    every = event_messages(spark, sf_dir).groupBy("source", "topic").agg(F.count("*").alias("n"))
    return every.join(late, ["source", "topic"], "left").select("source", "topic", "n", F.coalesce("n_late", F.lit(0)).alias("n_late"))


@query(f"WITH {EV} SELECT source, ns // {DAY} * {DAY} AS bucket_ns, count(*) AS n_messages, false AS complete FROM ev GROUP BY 1, 2")
def stream_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed aligner over all sources, where a required feature never comes: every frame is closed by time or by its source's end."""
    return _aligned(_arriving(spark, sf_dir, False), ["no such"]).where("kind = 'frame'").select("source", "bucket_ns", "n_messages", "complete")


@query(f"WITH {EV}, g AS (SELECT *, CASE WHEN ns - lag(ns) OVER (PARTITION BY source ORDER BY seq) > {DAY} THEN 1 ELSE 0 END AS j FROM ev) SELECT seq, CAST(sum(j) OVER (PARTITION BY source ORDER BY seq) AS BIGINT) AS episode FROM g")
def streamed_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes by gap from a stream of all events in four parts: session windows into a committed table, then numbers and an interval join."""
    root = shared_path(spark, "sessions")
    timed = lambda df: df.withColumn("event_time", F.timestamp_micros(F.expr("log_time_ns div 1000")))
    parts = [timed(p) for p in _arriving(spark, sf_dir, False)[:PARTS]]
    messages = timed(event_messages(spark, sf_dir))
    # the last part's end: a message of a source of its own, behind all gaps, moves the watermark past the last session
    top = messages.agg(F.max("log_time_ns").alias("t"))
    end = top.select(F.lit(-1).cast("long").alias("source"), F.lit("").alias("feature"), F.lit(-1).cast("long").alias("seq"), (F.coalesce("t", F.lit(0)) + 10 * DAY).alias("log_time_ns"), F.array().cast("array<float>").alias("data"))
    gap = f"{DAY // 1000 + 1} microseconds"  # a message that is a whole day behind goes on with the episode

    def start(stream: DataFrame, notes: str):
        return lake.stream_into(sessions.sessions(stream, ["source"], gap), root, notes).trigger(availableNow=True).start()

    arrivals.run_in_parts([*parts, timed(end)], start)
    found = lake.load(spark, root).where("source >= 0")
    return sessions.assigned(messages, found, ["source"]).select("seq", "episode")


# --- recordings made by tasks


def _recorded(spark: SparkSession, sf_dir: str, where: str, root: str) -> int:
    """Events as recordings, a file a source or part of one; how many messages were written."""
    own = event_messages(spark, sf_dir).where(where).withColumn("payload", F.to_json(F.struct(F.col("seq").alias("id"), F.col("data")[0].alias("v"))))
    return splits.write_recordings(own, root).agg(F.sum("messages")).head()[0] or 0


def _read_back(found: DataFrame) -> DataFrame:
    parts = F.from_json("data", "id long, v double")
    source = F.regexp_extract("source_file", r"(\d+)-\d+\.mcap$", 1).cast("long")
    return found.select(source.alias("source"), "topic", "log_time_ns", parts["id"].alias("id"), F.round(parts["v"], 3).alias("v"))


_EVENTS = f"WITH {EV} SELECT source, topic, ns AS log_time_ns, seq AS id, round(CAST(v AS DOUBLE), 3) AS v FROM ev"


@query(_EVENTS)
def recorded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as recordings that tasks write, cut at their chunks and read by byte ranges."""
    root = shared_path(spark, "recordings")
    _recorded(spark, sf_dir, "true", root)
    return _read_back(splits.read_splits(spark, root, split_bytes=4096))


@query(f"{_EVENTS} WHERE topic IN ('click', 'error') AND ns >= 1704844800000000000 AND ns < 1705708800000000000")
def recorded_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics of ten days of the same recordings: only chunks that have some of them are read."""
    root = shared_path(spark, "recordings")
    _recorded(spark, sf_dir, "true", root)
    return _read_back(splits.read_splits(spark, root, ["click", "error"], 1704844800 * clock.NS, 1705708800 * clock.NS))


@query(_EVENTS)
def streamed_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prefix of recordings that grows in three steps, streamed to a committed table from one checkpoint."""
    root, notes, out = (shared_path(spark, kind) for kind in ("recordings", "notes", "messages"))
    splits.register(spark)
    for k in range(3):
        _recorded(spark, sf_dir, f"source % 3 = {k}", root)
        stream = spark.readStream.format("recordings").option("path", root).load()
        lake.stream_into(stream, out, notes).trigger(availableNow=True).start().awaitTermination()
    return _read_back(lake.load(spark, out))


# --- what lasts over runs


@query("SELECT p_type AS task, row_number() OVER (ORDER BY min(p_partkey), p_type) - 1 AS task_index FROM part GROUP BY 1")
def lasting_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of parts as tasks, registered in four arrivals and once more: the indices of one pass."""
    own = dictionary.TaskDictionary(spark, shared_path(spark, "tasks"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    n = parts.agg(F.max("p_partkey")).head()[0] or 0
    for k in (0, 1, 2, 3, 1):
        own.extend(parts.where(F.floor(F.col("p_partkey") * 4 / F.lit(n + 1)) == k), "p_type", ["p_partkey"])
    return own.tasks()


@query("SELECT l_orderkey AS episode_index, l_linenumber AS frame_index, l_partkey, l_quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def converted_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as files that become more over three runs, a run repeated: the lines of each are converted once."""
    root = shared_path(spark, "converted")
    files = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("path"), F.floor("o_totalprice").cast("long").alias("length"), F.unix_date(F.col("o_orderdate").cast("date")).cast("long").alias("modified"))
    lines = table(spark, sf_dir, "lineitem")

    def convert(todo: DataFrame) -> DataFrame:
        own = lines.join(todo, lines["l_orderkey"] == F.col("path").cast("long"), "left_semi")
        return own.select(F.col("l_orderkey").alias("episode_index"), F.col("l_linenumber").alias("frame_index"), "l_partkey", "l_quantity")

    cuts = files.approxQuantile("modified", [0.3, 0.7, 1.0], 0.01)
    for cut in (cuts[0], cuts[1], cuts[1], 10**9) if cuts else ():
        incremental.run(files.where(F.col("modified") <= cut), root, convert)
    return lake.load(spark, root) if cuts else convert(files.limit(0))
