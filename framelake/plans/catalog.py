"""Every registered query of the dataset engine, and its DuckDB SQL.

The test tables play recordings: events are messages (a user is a source, an event type a topic), lineitem are frames
(an order is an episode, a line a frame), embeddings are state vectors (a label is an episode), orders are work units.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions import clock, media, names, values
from framelake.operators import align, control, episodes, frames, mapping, merge, metadata, stats, validate, video
from framelake.sources.tables import event_messages, line_frames, table
from framelake.streaming import aligner

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DAY = 86_400 * clock.NS
MAPPINGS = [("click", "action.click", "action"), ("view", "observation.view", "state"), ("purchase", "observation.state", "state")]
REQUIRED = ["click", "view"]

EV = "ev AS (SELECT user_id AS source, event_type AS topic, epoch_us(ts) * 1000 AS ns, event_id AS seq, CAST(value AS FLOAT) AS v FROM events)"
MAP = "map(topic, feature, type) AS (VALUES ('click', 'action.click', 'action'), ('view', 'observation.view', 'state'), ('purchase', 'observation.state', 'state'))"
FR = """fr AS (SELECT l_orderkey AS episode_index, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS frame_index,
  CASE WHEN l_linenumber % 3 <> 0 THEN [CAST(l_quantity AS FLOAT), CAST(l_extendedprice AS FLOAT)] END AS state,
  CASE WHEN l_linenumber % 4 <> 0 THEN [CAST(l_discount AS FLOAT), CAST(l_tax AS FLOAT)] END AS action FROM lineitem)"""
UN = """un AS (SELECT o_orderkey AS id, o_custkey % 20 AS batch, o_custkey % 7 AS owner, CAST(o_orderkey % 5 AS INTEGER) AS attempts,
  ['Complete', 'Processing', 'Pending', 'Failed', 'Dead', 'Cancelled'][1 + CAST((o_orderkey // 3) % 6 AS INTEGER)] AS status, CAST(floor(o_totalprice) AS BIGINT) AS size FROM orders)"""
STATES = ["Complete", "Processing", "Pending", "Failed", "Dead", "Cancelled"]


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.renamed(event_messages(spark, sf_dir), mapping.mapping_table(spark, MAPPINGS))


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = F.element_at(F.array(*map(F.lit, STATES)), (F.floor(key / 3) % 6 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(
        key.alias("id"), (F.col("o_custkey") % 20).alias("batch"), (F.col("o_custkey") % 7).alias("owner"), (key % 5).cast("int").alias("attempts"),
        status.alias("status"), F.floor("o_totalprice").cast("long").alias("size"),
    )


# --- scans and mapping


@query(f"WITH {EV}, c AS (SELECT source, ns - ns % {DAY} AS b, topic FROM ev), f AS (SELECT DISTINCT source, b FROM c) SELECT source, count(*) AS n_frames FROM f GROUP BY source")
def frames_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned frames of each recording, on a grid of a day."""
    messages = mapping.with_role(_mapped(spark, sf_dir))
    framed = align.not_empty(align.frames(align.bucketed(messages, interval=DAY), ["source"]))
    return framed.groupBy("source").agg(F.count("*").alias("n_frames"))


@query(f"WITH {EV} SELECT topic, count(*) AS message_count, min(ns) AS start_ns, max(ns) AS end_ns, greatest(0, max(ns) - min(ns)) AS duration_ns, CASE WHEN max(ns) > min(ns) THEN count(*) * 1e9 / (max(ns) - min(ns)) ELSE 0 END AS frequency_hz FROM ev GROUP BY topic")
def topic_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.topic_metadata(event_messages(spark, sf_dir))


@query(f"WITH {EV}, {MAP} SELECT seq, coalesce(feature, ltrim(replace('/robot/' || ev.topic, '/', '.'), '.')) AS feature FROM ev LEFT JOIN map USING (topic)")
def feature_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(spark, sf_dir).withColumn("topic", F.concat(F.lit("/robot/"), "topic"))
    table_ = mapping.mapping_table(spark, [(f"/robot/{t}", f, k) for t, f, k in MAPPINGS])
    return mapping.renamed(messages, table_).select("seq", "feature")


@query(f"WITH {EV}, {MAP} SELECT seq, topic FROM ev SEMI JOIN map USING (topic)")
def topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.filtered(event_messages(spark, sf_dir), mapping.mapping_table(spark, MAPPINGS)).select("seq", "topic")


@query("SELECT * FROM (VALUES ('click', 'action.click', 'action'), ('view', 'observation.view', 'state'), ('purchase', 'observation.state', 'state'), ('error', 'error', 'image'), ('signup', 'signup', 'image')) t(topic, feature, type)")
def mapping_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = event_messages(spark, sf_dir).select("topic", F.col("topic").alias("feature"), F.lit("state").alias("type")).distinct()
    return mapping.merge_mappings(mapping.mapping_table(spark, MAPPINGS), topics)


@query(f"WITH {EV}, {MAP} SELECT seq, CASE WHEN type IN ('state', 'action') THEN type WHEN ev.topic = 'action' OR contains(ev.topic, '.action') THEN 'action' ELSE 'state' END AS role FROM ev LEFT JOIN map USING (topic)")
def feature_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.with_role(_mapped(spark, sf_dir)).select("seq", "role")


@query(f"WITH {EV}, i AS (SELECT *, row_number() OVER (PARTITION BY source, topic ORDER BY seq) AS n FROM ev WHERE topic = 'error') SELECT source, seq FROM i WHERE n = 1")
def camera_info_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first calibration message of each source and topic; error events play that part."""
    _, infos = mapping.split_camera_info(event_messages(spark, sf_dir), F.col("topic") == "error", ["seq"], ["source", "topic"])
    return infos.select("source", "seq")


@query("SELECT e.vec_id, len(list_filter(range(1, 65), lambda i: ['float32', 'int8', 'uint16', 'float64', 'int64', 'string'][1 + (i - 1) % 6] IN ('float32', 'float64', 'int64'))) AS n_kept, round(list_sum(list_transform(list_filter(range(1, 65), lambda i: ['float32', 'int8', 'uint16', 'float64', 'int64', 'string'][1 + (i - 1) % 6] IN ('float32', 'float64', 'int64')), lambda i: CAST(embedding[i] AS DOUBLE))), 5) AS total FROM embeddings e")
def vector_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements whose number type counts; types repeat along the vector."""
    kinds = F.array(*[F.lit(["float32", "int8", "uint16", "float64", "int64", "string"][i % 6]) for i in range(64)])
    kept = values.vector_of(F.col("embedding"), kinds)
    total = F.aggregate(kept, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size(kept).cast("long").alias("n_kept"), F.round(total, 5).alias("total"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity - 25 BETWEEN 0 AND 4294967295 AND l_quantity = floor(l_quantity) THEN CAST(l_quantity - 25 AS BIGINT) END AS n FROM lineitem")
def u32_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", values.u32(F.col("l_quantity") - 25).alias("n"))


# --- frames


@query(f"WITH {EV} SELECT seq, ns // 33333333 * 33333333 AS bucket_ns FROM ev")
def frame_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.bucketed(event_messages(spark, sf_dir), fps=30).select("seq", "bucket_ns")


@query(f"WITH {EV} SELECT seq, (ns + (33333333 + 1) // 2) // 33333333 * 33333333 AS bucket_ns FROM ev")
def frame_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.bucketed(event_messages(spark, sf_dir), fps=30, mode="round").select("seq", "bucket_ns")


@query(f"WITH {EV} SELECT source, ns // {DAY} * {DAY} AS bucket_ns, topic AS feature, arg_max(v, seq) AS v, count(*) AS n_messages FROM ev GROUP BY ALL")
def frame_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(spark, sf_dir).withColumn("feature", F.col("topic"))
    out = align.last_wins(align.bucketed(messages, interval=DAY), ["source"])
    return out.select("source", "bucket_ns", "feature", F.get("data", F.lit(0)).alias("v"), "n_messages")


@query(f"WITH {EV}, {MAP} SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY ns // {DAY}, seq) - 1 AS BIGINT) AS frame_index, ns // {DAY} * {DAY} AS timestamp_ns, CAST((topic <> 'click') AS INTEGER) AS n_states, CAST((topic = 'click') AS INTEGER) AS n_actions FROM ev")
def frame_per_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = align.bucketed(mapping.with_role(_mapped(spark, sf_dir)), interval=DAY)
    out = align.frames(messages, ["source"], emit="per_message")
    return out.select("source", "frame_index", "timestamp_ns", F.size("states").alias("n_states"), F.size("actions").alias("n_actions"))


@query(f"WITH {EV} SELECT source, ns // {DAY} * {DAY} AS bucket_ns, array_to_string(list_sort(list(DISTINCT topic)), ',') AS features, count(*) AS n_messages, list_has_all(list(DISTINCT topic), ['click', 'view']) AS complete FROM ev GROUP BY source, ns // {DAY}")
def frame_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(spark, sf_dir).withColumn("feature", F.col("topic"))
    out = align.completeness(align.bucketed(messages, interval=DAY), ["source"], REQUIRED)
    return out.withColumn("features", F.array_join("features", ","))


@query(f"WITH {EV}, c AS (SELECT list_has_all(list(DISTINCT topic), ['click', 'view']) AS complete FROM ev GROUP BY source, ns // {DAY}) SELECT count(*) FILTER (complete) AS normal, count(*) FILTER (NOT complete) AS forced, count(*) FILTER (complete) / count(*) AS completion_rate FROM c")
def alignment_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(spark, sf_dir).withColumn("feature", F.col("topic"))
    return align.alignment_stats(align.completeness(align.bucketed(messages, interval=DAY), ["source"], REQUIRED))


@query(f"WITH {EV}, c AS (SELECT source, ns // {DAY} * {DAY} AS bucket_ns, topic, arg_max(v, seq) AS v, count(*) AS n FROM ev GROUP BY ALL) SELECT source, bucket_ns, array_to_string(list(topic ORDER BY topic), ',') AS features, round(sum(v), 3) AS total, CAST(sum(n) AS BIGINT) AS n_messages, list_has_all(list(topic), ['click', 'view']) AS complete FROM c GROUP BY ALL")
def aligned_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming aligner's frames, from a table."""
    messages = event_messages(spark, sf_dir).withColumn("feature", F.col("topic"))
    out = aligner.batch_aligned(messages, 0, REQUIRED, interval=DAY)
    total = F.aggregate(F.flatten("data"), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return out.select("source", "bucket_ns", F.array_join("features", ",").alias("features"), F.round(total, 3).alias("total"), "n_messages", "complete")


@query(f"WITH {EV}, {MAP}, m AS (SELECT ev.*, coalesce(feature, ev.topic) AS feature, CASE WHEN type = 'action' THEN 'action' ELSE 'state' END AS role FROM ev LEFT JOIN map USING (topic)), c AS (SELECT source, ns // {DAY} AS b, feature, role, arg_max(v, seq) AS v FROM m GROUP BY ALL) SELECT source, b * {DAY} AS timestamp_ns, arg_min(v, feature) FILTER (role = 'state' AND (contains(feature, 'observation') OR contains(feature, 'state'))) AS state, arg_min(v, feature) FILTER (role = 'action') AS action, CAST(b * {DAY} AS DOUBLE) / 1e9 AS timestamp FROM c GROUP BY source, b")
def frame_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = align.bucketed(mapping.with_role(_mapped(spark, sf_dir)), interval=DAY)
    out = frames.project(align.frames(messages, ["source"]))
    return out.select("source", "timestamp_ns", F.get("state", F.lit(0)).alias("state"), F.get("action", F.lit(0)).alias("action"), "timestamp")


@query(f"WITH {EV}, g AS (SELECT *, CASE WHEN ns - lag(ns) OVER (PARTITION BY source ORDER BY seq) > {3 * DAY} THEN 1 ELSE 0 END AS j FROM ev), e AS (SELECT DISTINCT source, CAST(sum(j) OVER (PARTITION BY source ORDER BY seq) AS BIGINT) AS episode, ns // {DAY} * {DAY} AS timestamp_ns FROM g) SELECT source, episode, timestamp_ns FROM e QUALIFY row_number() OVER (PARTITION BY source ORDER BY episode, timestamp_ns) <= 5")
def max_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five frames of each source, over all its episodes."""
    messages = episodes.by_gap(_mapped(spark, sf_dir), 3 * DAY, ["source"], ["seq"])
    out = align.frames(align.bucketed(mapping.with_role(messages), interval=DAY), ["source", "episode"])
    return mapping.first_frames(out, 5, ["source"], ["episode", "frame_index"]).select("source", "episode", "timestamp_ns")


# --- episodes


@query(f"WITH {EV}, g AS (SELECT *, CASE WHEN ns - lag(ns) OVER (PARTITION BY source ORDER BY seq) > {DAY} THEN 1 ELSE 0 END AS j FROM ev) SELECT seq, CAST(sum(j) OVER (PARTITION BY source ORDER BY seq) AS BIGINT) AS episode FROM g")
def episode_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes.by_gap(event_messages(spark, sf_dir), DAY, ["source"], ["seq"]).select("seq", "episode")


@query(f"WITH {EV} SELECT seq, CAST(coalesce(sum(CAST(topic = 'view' AS INTEGER)) OVER (PARTITION BY source ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 4 AS BIGINT) AS episode FROM ev")
def episode_framecount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views play frames with images; four of them fill an episode."""
    out = episodes.by_frame_count(event_messages(spark, sf_dir), 4, ["source"], ["seq"], F.col("topic") == "view")
    return out.select("seq", "episode")


@query(f"WITH {EV} SELECT source, count(*) AS n, 0 AS episode FROM ev GROUP BY source")
def episode_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes.single(event_messages(spark, sf_dir)).groupBy("source", "episode").agg(F.count("*").alias("n"))


@query(f"WITH {EV}, l AS (SELECT source, seq, topic, lag(topic) OVER (PARTITION BY source ORDER BY seq) AS previous FROM ev) SELECT seq, topic, previous FROM l WHERE previous IS NULL OR previous <> topic")
def episode_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes.changes(event_messages(spark, sf_dir), ["source"], ["seq"], "topic").select("seq", "topic", "previous")


@query("SELECT user_id, event_type, CAST(dense_rank() OVER (ORDER BY user_id, event_type) - 1 AS BIGINT) AS episode_index FROM (SELECT DISTINCT user_id, event_type FROM events)")
def dense_episode(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "events").select("user_id", "event_type")
    return episodes.dense_numbers(keys, ["user_id", "event_type"])


@query("SELECT o_orderkey AS episode, o_orderkey // 500 AS chunk, o_orderkey % 500 AS chunk_offset, format('data/chunk-{:03d}/episode_{:06d}.parquet', o_orderkey // 500, o_orderkey) AS path, format('videos/chunk-{:03d}/cam/episode_{:06d}.mp4', o_orderkey // 500, o_orderkey) AS video, o_orderkey AS parsed FROM orders")
def chunk_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    ep = F.col("o_orderkey")
    video = names.video_path(ep, F.lit("cam"))
    return table(spark, sf_dir, "orders").select(
        ep.alias("episode"), names.chunk_of(ep).alias("chunk"), (ep % 500).alias("chunk_offset"), names.parquet_path(ep).alias("path"), video.alias("video"), names.episode_in(video).alias("parsed")
    )


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(dense_rank() OVER (ORDER BY l_orderkey) - 1 AS BIGINT) AS episode_index, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS index, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS frame_in_episode FROM lineitem")
def global_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    out = episodes.reindexed(rows, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "episode_index", "index", "frame_in_episode")


@query(f"WITH {EV}, seg(source, s, e, label) AS (SELECT DISTINCT source, 1704067200000000000 + source % 9 * {DAY}, 1704067200000000000 + (source % 9 + 6) * {DAY}, 'skill ' || source % 3 FROM ev) SELECT seq, label FROM ev JOIN seg ON seg.source = ev.source AND ns >= s AND ns < e")
def annotation_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of marked time ranges for the messages inside them."""
    messages = event_messages(spark, sf_dir)
    start = F.lit(1704067200000000000) + F.col("source") % 9 * DAY
    marks = messages.select("source").distinct().select("source", start.alias("start"), (start + 6 * DAY).alias("end"), F.concat(F.lit("skill "), F.col("source") % 3).alias("label"))
    return episodes.annotated(messages, marks, "log_time_ns", ["source"]).select("seq", "label")


@query("SELECT o_custkey % 50 AS segment, min(epoch_us(o_orderdate)) AS start, max(epoch_us(o_orderdate)) AS \"end\", count(DISTINCT o_orderkey) AS n_episodes FROM orders GROUP BY 1")
def segment_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("segment"), t.alias("start"), t.alias("end"), F.col("o_orderkey").alias("episode_id"))
    return metadata.segment_rollup(rows).select("segment", "start", "end", F.size("episodes").cast("long").alias("n_episodes"))


# --- fill, pivot, statistics


@query(f"WITH {FR}, f AS (SELECT *, last_value(state IGNORE NULLS) OVER w AS s, last_value(action IGNORE NULLS) OVER w AS a FROM fr WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT episode_index, frame_index, s[1] AS s0, s[2] AS s1, a[1] AS a0, a[2] AS a1 FROM f")
def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = frames.forward_filled(line_frames(spark, sf_dir), ["episode_index"])
    at = lambda c, i: F.get(c, F.lit(i))
    return out.select("episode_index", "frame_index", at("state", 0).alias("s0"), at("state", 1).alias("s1"), at("action", 0).alias("a0"), at("action", 1).alias("a1"))


@query(f"WITH {FR}, d AS (SELECT episode_index FROM fr GROUP BY 1 HAVING count(state) > 0), f AS (SELECT fr.*, last_value(state IGNORE NULLS) OVER w AS s, last_value(action IGNORE NULLS) OVER w AS a FROM fr SEMI JOIN d USING (episode_index) WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT episode_index, frame_index, coalesce(s[1], 0) AS \"observation.state.0\", coalesce(s[2], 0) AS \"observation.state.1\", coalesce(a[1], 0) AS \"action.0\", coalesce(a[2], 0) AS \"action.1\" FROM f")
def vector_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frame of episodes that have a state, filled, a column a dimension."""
    out = frames.filled(line_frames(spark, sf_dir), ["episode_index"])
    return frames.pivoted(out.drop("state_dim", "action_dim"), {"state": ("observation.state", 2), "action": ("action", 2)})


@query(f"WITH {FR}, k AS (SELECT *, last_value(action IGNORE NULLS) OVER (PARTITION BY episode_index ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a FROM fr WHERE state IS NOT NULL) SELECT episode_index, frame_index, state[1] AS s0, coalesce(a[1], 0) AS a0, coalesce(a[2], 0) AS a1 FROM k")
def stated_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stricter writer's rows: frames with a state, and actions as seen on those."""
    out = frames.stated_only(line_frames(spark, sf_dir), ["episode_index"])
    return out.select("episode_index", "frame_index", F.get("state", F.lit(0)).alias("s0"), F.get("action", F.lit(0)).alias("a0"), F.get("action", F.lit(1)).alias("a1"))


@query(f"WITH {FR} SELECT episode_index FROM fr GROUP BY 1 HAVING count(state) = 0")
def episodes_without_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.without_state(line_frames(spark, sf_dir), ["episode_index"])


_STATS = "SELECT {by}, CAST(i - 1 AS INTEGER) AS dim, count(*) AS n_rows, min(x) AS min, max(x) AS max, CAST(sum(x) / count(*) AS FLOAT) AS mean, round(sqrt(greatest(0, sum(x * x) / count(*) - (sum(x) / count(*)) ** 2)), 4) AS std FROM ({cells}) GROUP BY ALL"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("mean", F.col("mean").cast("float")).withColumn("std", F.round("std", 4))


@query(_STATS.format(by="label", cells="SELECT label, unnest(range(1, 65)) AS i, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings"))
def vector_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.vector_stats(table(spark, sf_dir, "embeddings"), ["label"], "embedding", "vec_id"))


@query(f"WITH {FR} " + _STATS.format(by="episode_index, feature", cells="SELECT episode_index, 'observation.state' AS feature, unnest([1, 2]) AS i, CAST(state[i] AS DOUBLE) AS x FROM fr WHERE state IS NOT NULL UNION ALL SELECT episode_index, 'action', unnest([1, 2]) AS i, CAST(action[i] AS DOUBLE) FROM fr WHERE action IS NOT NULL"))
def episode_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.episode_stats(line_frames(spark, sf_dir), ["episode_index"], {"observation.state": "state", "action": "action"}))


@query("WITH c AS (SELECT label, unnest(range(1, 65)) AS i, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings), s AS (SELECT label, i, count(*) AS n, min(x) AS lo, max(x) AS hi, avg(x) AS m, sqrt(greatest(0, sum(x * x) / count(*) - avg(x) ** 2)) AS sd FROM c GROUP BY ALL), t AS (SELECT i, sum(n) AS nn, min(lo) AS lo, max(hi) AS hi, sum(n * m) / sum(n) AS mm, sum(sd * sd * (n - 1)) AS m2, sum(n * m * m) AS nmm FROM s GROUP BY i) SELECT CAST(i - 1 AS INTEGER) AS dim, CAST(nn AS BIGINT) AS n_rows, lo AS min, hi AS max, CAST(mm AS FLOAT) AS mean, round(sqrt((m2 + greatest(0, nmm - nn * mm * mm)) / (nn - 1)), 4) AS std FROM t")
def global_stats_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.merged(stats.vector_stats(table(spark, sf_dir, "embeddings"), ["label"], "embedding", "vec_id"), ["dim"]))


@query("SELECT CAST(i - 1 AS INTEGER) AS dim, count(*) AS n_rows, min(x) AS min, max(x) AS max, CAST(avg(x) AS FLOAT) AS mean, round(stddev_pop(x), 4) AS std FROM (SELECT unnest(range(1, 65)) AS i, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings) GROUP BY ALL")
def global_stats_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged statistics that equal those of all rows at once."""
    parts = stats.vector_stats(table(spark, sf_dir, "embeddings"), ["label"], "embedding", "vec_id")
    return _rounded(stats.merged(parts, ["dim"], exact=True))


@query(f"WITH {FR} SELECT count(DISTINCT episode_index) AS total_episodes, count(*) AS total_frames FROM fr")
def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_frames(spark, sf_dir).groupBy("episode_index").agg(F.count("*").alias("length"))
    return stats.totals(lines)


@query("SELECT CAST(sum(o_orderkey % 100) AS BIGINT) AS frames, CAST(sum(floor(o_totalprice)) AS BIGINT) AS bytes, max(o_custkey % 60) AS seconds, round(sum(o_orderkey % 100) / max(o_custkey % 60), 6) AS fps, round(sum(floor(o_totalprice)) / 1048576 / max(o_custkey % 60), 6) AS mb_per_sec FROM orders")
def writer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 100).alias("frames"), F.floor("o_totalprice").alias("bytes"), (F.col("o_custkey") % 60).alias("seconds"))
    return stats.writer_totals(parts).withColumns({"fps": F.round("fps", 6), "mb_per_sec": F.round("mb_per_sec", 6)})


# --- metadata and validation


@query("SELECT p_type AS task, row_number() OVER (ORDER BY min(p_partkey)) - 1 AS task_index FROM part GROUP BY p_type")
def task_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.task_dictionary(table(spark, sf_dir, "part"), "p_type", ["p_partkey"])


_EP = "WITH t AS (SELECT p_type AS task, row_number() OVER (ORDER BY min(p_partkey)) - 1 AS task_index FROM part GROUP BY p_type), r AS (SELECT l_orderkey AS episode_index, task_index FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN t ON p_type = task)"


def _episode_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("task"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("episode_index"), "l_partkey")
    return metadata.episode_lines(rows.join(part, F.col("l_partkey") == F.col("p_partkey"), "left"), task_dictionary(spark, sf_dir))


@query(_EP + " SELECT episode_index, count(*) AS length, array_to_string(list_sort(list(DISTINCT task_index) FILTER (task_index IS NOT NULL)), ',') AS tasks FROM r GROUP BY 1")
def episode_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _episode_lines(spark, sf_dir).withColumn("tasks", F.array_join("tasks", ","))


@query(_EP + " SELECT '{\"episode_index\":' || episode_index || ',\"length\":' || count(*) || ',\"tasks\":[' || array_to_string(list_sort(list(DISTINCT task_index) FILTER (task_index IS NOT NULL)), ',') || ']}' AS value FROM r GROUP BY episode_index")
def episodes_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.as_lines(_episode_lines(spark, sf_dir), "episode_index")


@query("WITH g AS (SELECT unnest(range(0, (SELECT max(event_id // 7 * 3) FROM events) + 1)) AS episode_index) SELECT episode_index FROM g ANTI JOIN (SELECT event_id // 7 * 3 AS episode_index FROM events) USING (episode_index)")
def missing_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = table(spark, sf_dir, "events").select((F.floor(F.col("event_id") / 7) * 3).alias("episode_index"))
    return validate.missing_episodes(present)


_PR = "p AS (SELECT DISTINCT user_id AS episode_index, event_type || date_part('day', ts) % 4 AS feature FROM events)"


def _present(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("episode_index"), F.concat("event_type", F.dayofmonth("ts") % 4).alias("feature"))


@query(f"WITH {_PR} SELECT feature, (SELECT count(DISTINCT episode_index) FROM p) - count(*) AS n_missing FROM p GROUP BY feature HAVING n_missing > 0")
def sparse_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.sparse_features(_present(spark, sf_dir))


@query(f"WITH {_PR} SELECT feature, count(*) AS n_episodes, round(count(*) / (SELECT count(DISTINCT episode_index) FROM p), 9) AS share FROM p GROUP BY feature")
def dataset_inspector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.inspect(_present(spark, sf_dir)).withColumn("share", F.round("share", 9))


@query("WITH a AS (SELECT DISTINCT user_id AS episode_index, event_type AS feature FROM events), b AS (SELECT DISTINCT user_id AS episode_index, event_type AS feature FROM events WHERE event_id % 5 = 0) SELECT * FROM a ANTI JOIN b USING (episode_index, feature)")
def missing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("episode_index"), F.col("event_type").alias("feature"), "event_id")
    return validate.missing_stats(e, e.where("event_id % 5 = 0"))


@query("SELECT p_type AS task, array_to_string(list_sort(list(DISTINCT p_size)), ',') AS indices FROM part GROUP BY 1 HAVING count(DISTINCT p_size) > 1")
def dup_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = validate.duplicate_tasks(table(spark, sf_dir, "part").select(F.col("p_type").alias("task"), F.col("p_size").alias("task_index")))
    return out.withColumn("indices", F.array_join("indices", ","))


_SPEC = "s AS (SELECT event_id AS episode_index, event_type AS feature, 'float32:' || user_id % 3 AS spec FROM events)"


def _specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("episode_index"), F.col("event_type").alias("feature"), F.concat(F.lit("float32:"), F.col("user_id") % 3).alias("spec"))


@query(f"WITH {_SPEC}, f AS (SELECT feature, arg_min(spec, episode_index) AS expected FROM s GROUP BY 1) SELECT episode_index, feature, spec, expected FROM s JOIN f USING (feature) WHERE spec IS DISTINCT FROM expected")
def feature_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.mismatched_specs(_specs(spark, sf_dir))


@query(f"WITH {_SPEC} SELECT feature, count(DISTINCT spec) AS n_specs FROM s GROUP BY 1 HAVING n_specs > 1")
def feature_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.conflicting_features(_specs(spark, sf_dir))


@query("SELECT count(DISTINCT user_id) AS episodes, CAST((SELECT sum(u % 9) FROM (SELECT DISTINCT user_id AS u FROM events)) AS BIGINT) AS frames, count(DISTINCT event_type) AS features, count(DISTINCT props) AS tasks, count(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS videos FROM events")
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return validate.summary(e.select(F.col("user_id").alias("episode_index"), (F.col("user_id") % 9).alias("length"), F.col("event_type").alias("feature"), F.col("props").alias("task"), (F.col("event_type") == "view").alias("is_video")))


@query("SELECT l_orderkey AS id, CAST(NULL AS BIGINT) AS c, l_quantity AS q FROM lineitem UNION ALL SELECT o_orderkey, o_custkey, NULL FROM orders")
def diagonal_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_quantity").alias("q"))
    b = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c"), F.col("o_orderkey").alias("id"))
    return merge.diagonal_union([a, b]).select("id", "c", "q")


# --- control plane


@query(f"WITH {UN} SELECT id, size FROM un ANTI JOIN (SELECT id FROM un WHERE status = 'Complete') USING (id)")
def anti_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = _units(spark, sf_dir)
    return control.new_files(u.select("id", "size"), u.where("status = 'Complete'"))


@query(f"WITH {UN} SELECT id, size FROM un WHERE status = 'Complete'")
def semi_known_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = _units(spark, sf_dir)
    return control.known_files(u.select("id", "size"), u.where("status = 'Complete'"))


_BEAT = "hb AS (SELECT owner AS worker, max(id) AS last_heartbeat FROM un GROUP BY owner)"


def _stale(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    u = _units(spark, sf_dir)
    beats = u.groupBy(F.col("owner").alias("worker")).agg(F.max("id").alias("last_heartbeat"))
    top = u.agg(F.max("id").alias("n")).head()["n"] or 0
    return u, control.stale(beats, F.lit(top), 4)


@query(f"WITH {UN}, {_BEAT}, st AS (SELECT worker AS owner FROM hb WHERE (SELECT max(id) FROM un) - last_heartbeat > 4) SELECT id, owner FROM un SEMI JOIN st USING (owner) WHERE status = 'Processing'")
def semi_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.orphans(*_stale(spark, sf_dir)).select("id", "owner")


@query(f"WITH {UN}, {_BEAT}, st AS (SELECT worker AS owner FROM hb WHERE (SELECT max(id) FROM un) - last_heartbeat > 4), o AS (SELECT * FROM un SEMI JOIN st USING (owner) WHERE status = 'Processing' ORDER BY id LIMIT 10) SELECT id, CASE WHEN attempts >= 3 THEN 'Dead' ELSE 'Failed' END AS status, 'Worker died: ' || owner AS error FROM o")
def reclaim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.reclaimed(control.orphans(*_stale(spark, sf_dir)), 10).select("id", "status", "error")


@query("SELECT o_orderkey AS id, o_orderstatus AS phase, c_name AS name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 3 <> 0")
def spec_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches with both a status (orders) and a specification (customer)."""
    spec = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"))
    statuses = table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("order"), F.col("o_orderstatus").alias("phase"), "o_custkey")
    return control.batch_summaries(spec, statuses, "o_custkey").select(F.col("order").alias("id"), "phase", "name")


_CNT = "c AS (SELECT batch, count(*) FILTER (status = 'Complete') AS completed, count(*) FILTER (status IN ('Failed', 'Dead')) AS failed, count(*) FILTER (status = 'Processing') AS processing FROM un GROUP BY batch), n AS (SELECT *, completed + failed + processing AS total FROM c)"


@query(f"WITH {UN}, {_CNT} SELECT * FROM n")
def unit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.unit_counts(_units(spark, sf_dir), ["batch"])


@query(f"WITH {UN} SELECT batch, count(*) AS n, min(id) AS first_id, CAST(sum(id * attempts) AS BIGINT) AS checked FROM un WHERE status IN ('Failed', 'Dead') GROUP BY batch")
def failed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = control.failed_units(_units(spark, sf_dir), ["batch"], ["id", "size", "attempts"])
    return out.select("batch", F.size("failed_units").cast("long").alias("n"), F.expr("failed_units[0].id").alias("first_id"), F.expr("aggregate(failed_units, 0L, (a, x) -> a + x.id * x.attempts)").alias("checked"))


@query(f"WITH {UN}, {_CNT}, l AS (SELECT *, (SELECT median(failed) FROM n) AS lim FROM n) SELECT batch, CASE WHEN failed > 250 THEN 'Failed' WHEN completed + failed >= total AND total > 0 THEN CASE WHEN failed > 0 THEN 'Failed' ELSE 'Merging' END ELSE 'Running' END AS phase FROM l")
def batch_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.verdict(unit_counts(spark, sf_dir), 250).select("batch", "phase")


@query(f"WITH {UN}, {_CNT} SELECT batch, round(CASE WHEN total > 0 THEN completed * 100.0 / total ELSE 0 END, 6) AS percent, round(CASE WHEN completed > 0 THEN greatest(0, 60.0 * 100 / (completed * 100.0 / total) - 60.0) END, 5) AS seconds_left FROM n")
def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = unit_counts(spark, sf_dir)
    percent = control.progress(F.col("completed"), F.col("total"))
    return c.select("batch", F.round(percent, 6).alias("percent"), F.round(control.remaining(F.lit(60.0), percent), 5).alias("seconds_left"))


@query(f"WITH {UN} SELECT batch, min(id) AS id FROM un WHERE status = 'Pending' GROUP BY batch")
def first_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.first_pending(_units(spark, sf_dir), ["batch"])


@query(f"WITH {UN} SELECT id, status IN ('Pending', 'Failed') AND attempts < 3 AS claimable, CASE WHEN attempts >= 3 THEN 'Dead' ELSE 'Failed' END AS after_failure FROM un")
def claimable_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = _units(spark, sf_dir)
    return u.select("id", control.claimable(F.col("status"), F.col("attempts")).alias("claimable"), control.after_failure(F.col("attempts")).alias("after_failure"))


def _moves_sql(moves: dict) -> str:
    pairs = ", ".join(f"('{a}', '{b}')" for a, to in moves.items() for b in (a, *to))
    states = ", ".join(f"'{a}'" for a in moves)
    return f"WITH s(x) AS (SELECT unnest([{states}])), ok(a, b) AS (VALUES {pairs}) SELECT p.x AS from_state, q.x AS to_state FROM s p, s q WHERE (p.x, q.x) IN (SELECT a, b FROM ok)"


def _all_moves(spark: SparkSession, moves: dict) -> DataFrame:
    pairs = spark.createDataFrame([(a, b) for a in moves for b in moves], "from_state string, to_state string")
    return control.allowed(pairs, moves)


@query(_moves_sql(control.BATCH_MOVES))
def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_moves(spark, control.BATCH_MOVES)


@query(_moves_sql(control.UNIT_MOVES))
def unit_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_moves(spark, control.UNIT_MOVES)


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'P' ORDER BY 1 LIMIT 100")
def list_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing with its limit, in key order."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("phase"))
    return control.listed(rows, phase="P").select("id")


@query(f"WITH {UN}, u AS (SELECT id // 6 AS b, * FROM un) SELECT b FROM u GROUP BY b HAVING count(*) FILTER (status IN ('Complete', 'Failed', 'Dead')) > 0 AND count(*) FILTER (status = 'Processing') = 0 AND b % 4 <> 0")
def ready_to_finalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running batches with no unit at work; every fourth batch isn't running."""
    counts = control.unit_counts(_units(spark, sf_dir).withColumn("b", F.floor(F.col("id") / 6)), ["b"])
    return control.ready_to_finalize(counts.withColumn("phase", F.when(F.col("b") % 4 == 0, F.lit("Suspended")).otherwise(F.lit("Running")))).select("b")


@query("SELECT l_suppkey % 20 AS batch, CAST(sum(frames) AS BIGINT) AS frames, count(*) AS workers FROM (SELECT l_suppkey, arg_max(l_linenumber, l_orderkey * 10 + l_linenumber) AS frames FROM lineitem GROUP BY l_suppkey) GROUP BY 1")
def staged_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 20).alias("batch"), F.col("l_suppkey").alias("worker"), F.col("l_linenumber").alias("frames"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("reported_at"))
    return control.staged_frames(rows)


@query("SELECT o_orderkey AS id, CASE WHEN o_custkey % 5 = 0 THEN 100.0 ELSE (o_orderkey % 3 + o_orderkey % 2) * 100.0 / (o_custkey % 5) END AS percent FROM orders")
def upload_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(key.alias("id"), control.upload_progress(key % 3, key % 2, F.col("o_custkey") % 5).alias("percent"))


@query("SELECT arg_min(c_name, (c_acctbal, c_name)) AS path FROM customer")
def eviction_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = table(spark, sf_dir, "customer").select(F.col("c_name").alias("path"), F.col("c_acctbal").alias("last_accessed"))
    return control.eviction_candidate(entries)


@query(r"SELECT c_custkey, regexp_matches(lower(c_mktsegment) || ':' || c_custkey, '^[a-z0-9.-]+:[a-z0-9.-]+$') AS ok, regexp_matches(c_name, '^[a-z0-9.-]+:[a-z0-9.-]+$') AS bad FROM customer")
def batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ident = F.concat(F.lower("c_mktsegment"), F.lit(":"), "c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", names.batch_id_ok(ident).alias("ok"), names.batch_id_ok(F.col("c_name")).alias("bad"))


@query("SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'empty name' WHEN page_id % 4 = 1 THEN 'no sources' WHEN page_id % 4 = 2 THEN 'bad source url' WHEN page_id % 8 = 3 THEN 'bad output url' END AS fault FROM pages")
def spec_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 4
    name = F.when(k == 0, F.lit(" ")).otherwise(F.lit("run"))
    sources = F.when(k == 1, F.array().cast("array<string>")).when(k == 2, F.array(F.lit("s3:/x/y"))).otherwise(F.array(F.lit("s3://b/x.mcap")))
    output = F.when(F.col("page_id") % 8 == 3, F.lit("out")).otherwise(F.lit("file:///out"))
    return table(spark, sf_dir, "pages").select("page_id", names.spec_error(name, sources, output).alias("fault"))


# --- media


@query("SELECT * FROM (VALUES (0, 'jpeg', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)), (1, 'png', 640, 480), (2, 'png', NULL, NULL), (3, 'unknown', NULL, NULL), (4, 'unknown', NULL, NULL), (5, 'png', NULL, NULL)) t(id, format, width, height)")
def image_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format and PNG size of a few headers."""
    png = bytes.fromhex("89504E470D0A1A0A0000000D49484452")
    heads = [b"\xff\xd8\xff\xe0xx", png + (640).to_bytes(4) + (480).to_bytes(4), png, b"GIF89a", b"\xff\xd8", png + bytes(8)]
    df = spark.createDataFrame([(k, bytearray(h)) for k, h in enumerate(heads)], "id long, data binary")
    size = media.png_size(F.col("data"))
    return df.select("id", media.image_format(F.col("data")).alias("format"), size["width"].alias("width"), size["height"].alias("height"))


@query("SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS fx, CAST(embedding[5] AS DOUBLE) AS fy, CAST(embedding[3] AS DOUBLE) AS ppx, CAST(embedding[6] AS DOUBLE) AS ppy, CAST(embedding[10] AS DOUBLE) AS k1, CAST(embedding[11] AS DOUBLE) AS k2, CAST(0 AS DOUBLE) AS k3 FROM embeddings")
def intrinsics(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    found = media.intrinsics(F.slice(v, 1, 9), F.slice(v, 10, 4))
    return table(spark, sf_dir, "embeddings").select("vec_id", *[found[c].alias(c) for c in ("fx", "fy", "ppx", "ppy", "k1", "k2", "k3")])


@query("WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) + 2) AS v FROM embeddings) SELECT vec_id, round((v[10] - v[3] * v[18]) / v[1], 6) AS r00, round((v[14] - v[6] * v[18]) / v[5], 6) AS r10, round(v[18], 6) AS r20, round((v[13] - v[3] * v[21]) / v[1], 6) AS t0, round((v[17] - v[6] * v[21]) / v[5], 6) AS t1, round(v[21], 6) AS t2 FROM e")
def extrinsics(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.transform(F.col("embedding"), lambda x: x.cast("double") + 2)
    found = media.extrinsics(F.slice(v, 1, 9), F.slice(v, 10, 12))
    at = {"r00": ("rotation", 0), "r10": ("rotation", 3), "r20": ("rotation", 6), "t0": ("translation", 0), "t1": ("translation", 1), "t2": ("translation", 2)}
    return table(spark, sf_dir, "embeddings").select("vec_id", *[F.round(F.get(found[f], F.lit(i)), 6).alias(c) for c, (f, i) in at.items()])


@query("SELECT vec_id, CAST(64 // (1 + vec_id % 3) AS BIGINT) AS n_frames, round(64 / (16000.0 * (1 + vec_id % 3)), 9) AS seconds FROM embeddings")
def audio_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    channels = 1 + F.col("vec_id") % 3
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", media.audio_frames(F.col("embedding"), channels).cast("long").alias("n_frames"), F.round(media.audio_seconds(F.col("embedding"), F.lit(16000), channels), 9).alias("seconds")
    )


@query("SELECT l_orderkey, l_linenumber, CASE WHEN CAST(l_quantity AS BIGINT) % 2 = 0 THEN CAST(l_quantity AS BIGINT) * 4 * 3 // 2 END AS yuv, CAST(l_quantity AS BIGINT) * 4 * 3 AS rgb FROM lineitem")
def raw_frame_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.col("l_quantity").cast("long")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", media.raw_bytes(F.lit("yuv420p"), w, F.lit(4)).alias("yuv"), media.raw_bytes(F.lit("rgb24"), w, F.lit(4)).alias("rgb"))


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.when(F.col("l_quantity") < 25, 640).otherwise(320)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("episode_index"), F.lit("cam").alias("camera"), (F.col("l_orderkey") * 10000 + F.col("l_partkey") * 8 + F.col("l_linenumber")).alias("frame_index"),
        size.alias("width"), F.when(F.col("l_linenumber") == 7, 0).otherwise(240).alias("height"),
    )


_IMG = """im AS (SELECT l_suppkey AS episode_index, l_orderkey * 10000 + l_partkey * 8 + l_linenumber AS frame_index, CASE WHEN l_quantity < 25 THEN 640 ELSE 320 END AS width,
  CASE WHEN l_linenumber = 7 THEN 0 ELSE 240 END AS height FROM lineitem), ok AS (SELECT *, first_value(CASE WHEN height > 0 THEN width END IGNORE NULLS)
  OVER (PARTITION BY episode_index ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS w FROM im)"""


@query(f"WITH {_IMG} SELECT episode_index, count(*) FILTER (height > 0 AND width = w) AS kept, count(*) FILTER (NOT (height > 0 AND width = w)) AS skipped FROM ok GROUP BY 1")
def image_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images that have the size of their episode's first one, and those skipped."""
    return video.skipped(video.sized(_images(spark, sf_dir), ["episode_index"]), ["episode_index"])


@query(f"WITH {_IMG}, f AS (SELECT episode_index, (row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1) // 45 AS fragment FROM im) SELECT episode_index, fragment, count(*) AS frames FROM f GROUP BY 1, 2")
def video_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of each fragment: full at 60 frames or 1.5 seconds at 30 fps."""
    out = video.fragments(_images(spark, sf_dir), ["episode_index"], "frame_index", 60, 1.5, 30)
    return out.groupBy("episode_index", "fragment").agg(F.count("*").alias("frames"))


@query(f"WITH {UN} SELECT batch, CAST(sum(size) AS BIGINT) AS bytes, count(*) AS files FROM un GROUP BY batch")
def unit_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.unit_sizes(_units(spark, sf_dir), ["batch"])
