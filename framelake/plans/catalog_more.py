"""Further registered queries: readers, writer, conversion, streaming, stores, pictures and rules, over the test tables.

Recordings are made of small tables (a nation is a message); files go to the shared folder and are read back.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions import media, names, values
from framelake.operators import align, control, episodes, frames, mapping, merge, metadata, process, stats, validate, video
from framelake.plans.catalog import DAY, EV, FR, MAPPINGS, UN, _units, query
from framelake.plans.convert import convert, messages_of
from framelake.shared import shared_path
from framelake.sources import config, sidecars, store
from framelake.sources.generate import Out, bag_bytes, failing, mcap_bytes, pictures, with_gap
from framelake.sources.normalize import normalize_from_toml
from framelake.sources.recordings import read_messages, read_recordings, register_sources
from framelake.sources.tables import counted, event_messages, line_frames, multi_topic, table
from framelake.sources.writer import Files, assemble, write_calibrations, write_episodes, write_merged, write_metadata
from framelake.streaming import aligner

BASE = 1_700_000_000_000_000_000


def _save(spark: SparkSession, folder: str, name: str, data: bytes) -> None:
    files = Files(spark, folder)
    stream = files.fs.create(files.path(name), True)
    try:
        stream.write(data)
    finally:
        stream.close()


def _text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    _save(spark, folder, name, text.encode())


def _nations(spark: SparkSession, sf_dir: str) -> list:
    return table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()  # 25 rows at any size


JOINT = "string[] name\nfloat64[] position\nint8[] small"
PICTURE = "string format\nuint8[] data"


def _joint(k: int) -> bytes:
    import struct

    name = struct.pack("<II", 1, 1) + b"j"
    return name + struct.pack("<Idd", 2, 0.5 * k, -k) + struct.pack("<I", 3) + b"abc"


def _recording(spark: SparkSession, sf_dir: str) -> list[Out]:
    """A JSON vector, a joint state and a calibration or a picture of each nation."""
    out = []
    for r in _nations(spark, sf_dir):
        k, region = int(r["n_nationkey"]), int(r["n_regionkey"])
        t = BASE + k * 10_000_000
        out.append(Out("/vector", "json", t, json.dumps([k, region + 0.5, "x"]).encode()))
        out.append(Out("/joint", "ros1", t + 1, _joint(k), "sensor_msgs/JointState", JOINT))
        if k % 5 == 0:
            out.append(Out("/info", "json", t + 2, json.dumps({"K": [k + 1.0, 0, 2, 0, k + 3.0, 4, 0, 0, 1], "D": [region], "P": [1.0] * 12}).encode()))
        else:
            png = bytes.fromhex("89504E470D0A1A0A0000000D49484452") + (640 + k).to_bytes(4) + (480).to_bytes(4)
            out.append(Out("/picture", "json", t + 2, json.dumps({"format": "png", "data": list(png)}).encode()))
    return out


_NAT = "n AS (SELECT n_nationkey AS k, n_regionkey AS r FROM nation)"
_MSG = f"""{_NAT}, m AS (SELECT '/vector' AS topic, {BASE} + k * 10000000 AS log_time_ns FROM n UNION ALL SELECT '/joint', {BASE} + k * 10000000 + 1 FROM n
  UNION ALL SELECT CASE WHEN k % 5 = 0 THEN '/info' ELSE '/picture' END, {BASE} + k * 10000000 + 2 FROM n)"""


# --- readers


@query(f"WITH {_MSG} SELECT topic, count(*) AS n, CAST(min(log_time_ns) AS BIGINT) AS first_ns, CAST(max(log_time_ns) AS BIGINT) AS last_ns FROM m GROUP BY topic")
def mcap_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zstd MCAP file through Spark's file reader, by topic."""
    root = shared_path(spark, "recordings")
    _save(spark, root, "one.mcap", mcap_bytes(_recording(spark, sf_dir), "zstd", 7))
    return read_recordings(spark, root).groupBy("topic").agg(F.count("*").alias("n"), F.min("log_time_ns").alias("first_ns"), F.max("log_time_ns").alias("last_ns"))


@query(f"WITH {_MSG} SELECT topic, log_time_ns FROM m WHERE topic = '/joint' AND log_time_ns >= {BASE + 50_000_000} AND log_time_ns < {BASE + 200_000_000}")
def mcap_seek(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic and time reach the reader: only chunks that may have such messages are read."""
    register_sources(spark)
    root = shared_path(spark, "recordings")
    _save(spark, root, "one.mcap", mcap_bytes(_recording(spark, sf_dir), "lz4", 7))
    reader = spark.read.format("mcap").option("topics", "/joint").option("start_ns", BASE + 50_000_000).option("end_ns", BASE + 200_000_000)
    return reader.load(root).select("topic", "log_time_ns")


@query(f"WITH {_NAT} SELECT CAST(k AS BIGINT) AS k, 0.5 * k AS p0, CAST(-k AS DOUBLE) AS p1 FROM n")
def bag_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joint states of a bz2 bag, decoded."""
    root = shared_path(spark, "recordings")
    _save(spark, root, "one.bag", bag_bytes([m for m in _recording(spark, sf_dir) if m.encoding == "ros1"], "bz2", 4))
    at = lambda k: F.get("numbers", F.lit(k))
    rows = read_messages(spark, root).where("topic = '/joint'")
    return rows.select(F.expr(f"(log_time_ns - {BASE}) div 10000000").alias("k"), at(0).alias("p0"), at(1).alias("p1"))


@query(f"WITH {_MSG} SELECT topic, count(*) AS n FROM m GROUP BY topic")
def recording_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All recordings below a prefix: the messages, dealt to three files of two formats."""
    root, out = shared_path(spark, "recordings"), _recording(spark, sf_dir)
    joints = [m for m in out if m.encoding == "ros1"]
    _save(spark, root, "a/one.mcap", mcap_bytes([m for m in out if m.topic == "/vector"], "", 5, summary=False))
    _save(spark, root, "a/b/two.bag", bag_bytes(joints))
    _save(spark, root, "three.MCAP", mcap_bytes([m for m in out if m not in joints and m.topic != "/vector"], "zstd"))
    _text(spark, root, "notes.txt", "no recording")
    return read_recordings(spark, root).groupBy("topic").agg(F.count("*").alias("n"))


@query(f"WITH {_NAT} SELECT count(*) - 1 AS n, 0 AS blocks, 1 AS messages FROM n")
def recording_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message that can't be decoded is passed over and counted."""
    root = shared_path(spark, "recordings")
    out = [m for m in _recording(spark, sf_dir) if m.topic == "/vector"]
    out[3] = Out("/vector", "json", out[3].time_ns, b"{")
    _save(spark, root, "one.mcap", mcap_bytes(out, "", 5))
    rows = read_recordings(spark, root, report=True)
    fault = F.from_json("data", "blocks int, messages int")
    return rows.agg(F.count_if(F.col("seq") >= 0).alias("n"), F.max(F.when(F.col("seq") < 0, fault["blocks"])).alias("blocks"), F.max(F.when(F.col("seq") < 0, fault["messages"])).alias("messages"))


@query(f"WITH {_NAT} SELECT '/vector' AS topic, CAST(k AS FLOAT) AS x, CAST(r + 0.5 AS FLOAT) AS y, CAST(NULL AS BIGINT) AS width, CAST(NULL AS VARCHAR) AS kind FROM n UNION ALL SELECT '/joint', CAST(0.5 * k AS FLOAT), CAST(-k AS FLOAT), NULL, NULL FROM n UNION ALL SELECT '/picture', NULL, NULL, 640 + k, 'encoded' FROM n WHERE k % 5 <> 0")
def typed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What decoded messages contribute to frames: vectors and pictures; calibrations go another way."""
    root = shared_path(spark, "recordings")
    _save(spark, root, "one.mcap", mcap_bytes(_recording(spark, sf_dir), "", 9))
    rows, _ = messages_of(read_messages(spark, root))
    return rows.select("topic", F.get("data", F.lit(0)).alias("x"), F.get("data", F.lit(1)).alias("y"), "image.width", "image.kind")


@query("SELECT 'info' AS camera, 1.0 AS fx, 3.0 AS fy, CAST(0 AS DOUBLE) AS k1")
def calibration_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first calibration message of a camera, as a parameter file, read back."""
    root = shared_path(spark, "recordings")
    _save(spark, root, "one.mcap", mcap_bytes(_recording(spark, sf_dir), "", 9))
    _, infos = messages_of(read_messages(spark, root))
    infos = mapping.renamed(infos, mapping.mapping_table(spark, MAPPINGS))
    write_calibrations(mapping.calibrations(infos), f"{root}/out")
    found = spark.read.schema("fx double, fy double, k1 double").json(f"{root}/out/parameters/*_intrinsic.json")
    return found.select(F.regexp_extract(F.col("_metadata.file_name"), "^(.*)_intrinsic", 1).alias("camera"), "fx", "fy", "k1")


# --- writer and conversion


@query("SELECT CAST(l_suppkey AS BIGINT) AS episode_index, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS s, format('data/chunk-{:03d}/episode_{:06d}.parquet', l_suppkey // 50, l_suppkey) AS path FROM lineitem WHERE l_suppkey % 10 = 0 GROUP BY l_suppkey")
def dataset_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames to a dataset directory, a file an episode, and back."""
    root = shared_path(spark, "dataset")
    rows = table(spark, sf_dir, "lineitem").where("l_suppkey % 10 = 0").select(F.col("l_suppkey").cast("long").alias("episode_index"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("frame_index"), "l_linenumber")
    write_episodes(rows, root, per_chunk=50)
    back = merge.staged(spark, f"{root}/data")
    path = F.regexp_extract("file", "(data/chunk.*)$", 1)
    return back.groupBy("episode_index", path.alias("path")).agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("s"))


_CONV = f"""{EV}, s AS (SELECT source % 20 AS source, topic, ns, seq, v FROM ev WHERE topic IN ('click', 'view', 'purchase')), b AS (SELECT DISTINCT source, ns // {DAY} AS b FROM s),
  st AS (SELECT DISTINCT source FROM s WHERE topic = 'view' OR topic = 'purchase')"""


@query(f"WITH {_CONV}, d AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS episode_index FROM (SELECT DISTINCT source FROM b)) SELECT CAST(episode_index AS BIGINT) AS episode_index, count(*) AS n, CAST(0 AS BIGINT) AS first_frame, count(*) - 1 AS last_frame FROM b JOIN d USING (source) SEMI JOIN st USING (source) GROUP BY 1")
def converted_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to a dataset directory end to end; its episodes read back."""
    root = shared_path(spark, "dataset")
    messages = event_messages(spark, sf_dir).withColumn("source", F.col("source") % 20)
    own = config.Config("demo", fps=30, mappings=tuple(config.Mapping(*m) for m in MAPPINGS))
    # a grid of a day: times shrink so that a day is a frame's interval
    step = 33_333_333
    messages = messages.withColumn("log_time_ns", F.expr(f"log_time_ns div {DAY} * {step}"))
    convert(spark, messages, root, own, ["source"], task="pick")
    back = merge.staged(spark, f"{root}/data")
    return back.groupBy("episode_index").agg(F.count("*").alias("n"), F.min("frame_index").alias("first_frame"), F.max("frame_index").alias("last_frame"))


@query(f"WITH {_NAT}, f AS (SELECT k, k // 7 AS e FROM n) SELECT CAST(e AS BIGINT) AS episode_index, count(*) AS n, format('videos/chunk-000/camera/episode_{{:06d}}.mp4', CAST(e AS BIGINT)) AS path, CAST(0 AS BIGINT) AS first_frame FROM f GROUP BY e")
def converted_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with pictures: an episode is full at seven of them, its frames begin at 0, and rows name its video."""
    root, n = shared_path(spark, "dataset"), table(spark, sf_dir, "nation").count()
    vectors = multi_topic(spark, n, 2).withColumn("image", F.lit(None).cast(pictures(spark, 1).schema["image"].dataType))
    convert(spark, vectors.unionByName(pictures(spark, n)), root, config.Config("demo", frames_per_episode=7), ["source"])
    back = merge.staged(spark, f"{root}/data")
    return back.groupBy("episode_index", F.col("camera_path").alias("path")).agg(F.count("*").alias("n"), F.min("frame_index").alias("first_frame"))


@query(f"WITH {_NAT} SELECT CAST(k AS BIGINT) AS episode_index, CAST(r + 1 AS BIGINT) AS action_width, CAST(2 AS BIGINT) AS state_width FROM n")
def action_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions keep a width of their own, other than the state's."""
    rows = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("episode_index"), F.lit(0).cast("long").alias("frame_index"), F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>").alias("state"),
        F.array_repeat(F.lit(3.0), (F.col("n_regionkey") + 1).cast("int")).cast("array<float>").alias("action"),
    )
    out = frames.filled(rows, ["episode_index"])
    return out.select("episode_index", F.size("action").cast("long").alias("action_width"), F.size("state").cast("long").alias("state_width"))


@query("SELECT CAST(dense_rank() OVER (ORDER BY part, k) - 1 AS BIGINT) AS episode_index, CAST(row_number() OVER (ORDER BY part, k, line) - 1 AS BIGINT) AS index, part FROM (SELECT l_orderkey % 2 AS part, l_suppkey % 5 AS k, l_orderkey * 10 + l_linenumber AS line FROM lineitem WHERE l_suppkey < 10)")
def merged_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two staged datasets with the same episode numbers, merged: numbers anew, written and read back."""
    root = shared_path(spark, "merge")
    rows = table(spark, sf_dir, "lineitem").where("l_suppkey < 10").select((F.col("l_orderkey") % 2).alias("part"), (F.col("l_suppkey") % 5).cast("long").alias("episode_index"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("frame_index"))
    for part in (0, 1):
        write_episodes(rows.where(F.col("part") == part), f"{root}/{part}")
    staged = merge.staged(spark, root)
    keyed = staged.withColumn("__source", F.struct("part", "file_episode")).drop("episode_index", "index")
    write_merged(episodes.reindexed(keyed, "__source", ["frame_index"]).select("episode_index", "index", "part"), f"{root}/merged")
    return spark.read.schema("episode_index long, index long, part long").parquet(f"{root}/merged/data/chunk-000")


@query("SELECT CAST(label AS BIGINT) AS episode_index, CAST(64 AS BIGINT) AS width, count(*) AS n, round(max(CAST(embedding[1] AS DOUBLE)), 6) AS top FROM embeddings GROUP BY label")
def stats_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics as JSON lines, parsed again."""
    rows = table(spark, sf_dir, "embeddings").withColumn("episode_index", F.col("label").cast("long"))
    found = stats.episode_stats(rows, ["episode_index"], {"state": "embedding"}, "vec_id")
    text = metadata.as_lines(metadata.stats_lines(found), "episode_index")
    kind = "struct<episode_index:bigint,stats:map<string,struct<min:array<double>,max:array<double>,mean:array<double>,std:array<double>>>>"
    back = text.select(F.from_json("value", kind).alias("x")).select("x.episode_index", F.col("x.stats")["state"].alias("s"))
    n = rows.groupBy("episode_index").agg(F.count("*").alias("n"))
    return back.join(n, "episode_index").select("episode_index", F.size("s.max").cast("long").alias("width"), "n", F.round(F.get("s.max", F.lit(0)), 6).alias("top"))


@query("SELECT 'sf' AS name, CAST(NULL AS VARCHAR) AS robot_type, count(*) AS total_episodes, CAST(sum(c) AS BIGINT) AS total_frames, 25 AS n_tasks, 6 AS n_features FROM (SELECT n_regionkey, count(*) * 10 AS c FROM nation GROUP BY 1)")
def global_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of many writers' parts in one place, read back: regions are episodes, nations tasks."""
    root = shared_path(spark, "dataset")
    nation = table(spark, sf_dir, "nation")
    parts = nation.groupBy(F.col("n_regionkey").cast("long").alias("episode_index")).agg((F.count("*") * 10).alias("length"), F.collect_list("n_name").alias("tasks"))
    parts = parts.withColumn("tasks", F.concat("tasks", F.array(F.lit("unknown"))))
    tasks = nation.select(F.col("n_name").alias("task"), F.col("n_nationkey").cast("long").alias("task_index"))
    features = spark.createDataFrame([("state", "float32", [2]), ("camera", "video", [4, 4, 3])], "name string, dtype string, shape array<int>")
    none = spark.createDataFrame([], "episode_index long, feature string, dim int, min double, max double, mean double, std double")
    assemble(spark, root, "sf", 30, parts, tasks, features, none)
    info = spark.read.option("multiLine", "true").schema("name string, robot_type string, total_episodes long, total_frames long, features map<string,struct<dtype:string>>").json(f"{root}/meta/info.json")
    lines = spark.read.schema("episode_index long, length long, tasks array<long>").json(f"{root}/meta/episodes.jsonl")
    n_tasks = lines.agg(F.sum(F.size("tasks")).cast("int").alias("n_tasks"))
    return info.crossJoin(n_tasks).select("name", "robot_type", "total_episodes", "total_frames", "n_tasks", F.size("features").alias("n_features"))


@query("SELECT n_name AS task, CAST(n_nationkey AS BIGINT) AS task_index FROM nation")
def tasks_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a dataset's metadata, tasks read back."""
    root = shared_path(spark, "dataset")
    tasks = table(spark, sf_dir, "nation").select(F.col("n_name").alias("task"), F.col("n_nationkey").cast("long").alias("task_index"))
    lines = spark.createDataFrame([(0, 3, [0])], "episode_index long, length long, tasks array<int>")
    none = spark.createDataFrame([], "episode_index long, feature string, dim int, min double, max double, mean double, std double")
    write_metadata(spark, root, metadata.info({"total_episodes": 1, "total_frames": 3}, 30, {}), lines, tasks, none)
    return spark.read.schema("task string, task_index long").json(f"{root}/meta/tasks.jsonl")


# --- streaming


_DAYS = f"c AS (SELECT source, ns // {DAY} * {DAY} AS bucket_ns, topic, arg_max(v, seq) AS v, count(*) AS n FROM ev GROUP BY ALL)"


@query(f"WITH {EV}, {_DAYS} SELECT source, bucket_ns, array_to_string(list(topic ORDER BY topic), ',') AS features, round(sum(v), 3) AS total, CAST(sum(n) AS BIGINT) AS n_messages, list_has_all(list(topic), ['click', 'view']) AS complete FROM c GROUP BY ALL")
def stream_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table streamed to its end through the windowed aligner: the batch's frames."""
    messages = event_messages(spark, sf_dir).withColumn("feature", F.col("topic"))
    out = aligner.replayed(messages, 0, ["click", "view"], interval=DAY)
    total = F.aggregate(F.flatten("data"), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return out.select("source", "bucket_ns", F.array_join("features", ",").alias("features"), F.round(total, 3).alias("total"), "n_messages", "complete")


# --- stores and sidecars


@query("SELECT CAST(o_orderkey AS VARCHAR) AS episode_id, CAST(o_custkey AS BIGINT) AS total, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS BIGINT) ELSE CAST(0 AS BIGINT) END AS uploaded FROM orders WHERE o_orderkey % 5 <> 0")
def keyed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upload states put, put again and deleted by key; the last entry of a key counts."""
    own = store.KeyedTable(spark, shared_path(spark, "uploads"), store.UPLOADS, ("episode_id",))
    zero = F.lit(0).cast("long")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("episode_id"), F.col("o_custkey").cast("long").alias("total"), zero.alias("uploaded"), zero.alias("failed"))
    own.put(rows.drop("o_orderkey"))
    own.put(rows.where("o_orderkey % 3 = 0").withColumn("uploaded", F.col("total")).drop("o_orderkey"))
    own.delete(rows.where("o_orderkey % 5 = 0").select("episode_id"))
    return own.rows().select("episode_id", "total", "uploaded")


@query("SELECT CAST(o_orderstatus AS VARCHAR) AS batch, count(*) AS frames, CAST(0 AS BIGINT) AS bytes FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def stats_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = store.KeyedTable(spark, shared_path(spark, "stats"), store.STATS, ("batch",))
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("batch")).agg(F.count("*").alias("frames"))
    own.put(rows.select("batch", "frames", F.lit(0).cast("long").alias("bytes"), F.lit(1.0).alias("seconds")))
    own.delete(rows.where("batch = 'P'").select("batch"))
    return own.rows().select("batch", "frames", "bytes")


@query("SELECT count(*) AS stored, 5 AS asked FROM region")
def config_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configurations by the hash of their content: one put twice is there once."""
    own = store.KeyedTable(spark, shared_path(spark, "configs"), store.CONFIGS, ("hash",))
    regions = [r["r_name"] for r in table(spark, sf_dir, "region").collect()]  # five rows
    hashes = [store.put_config(own, {"name": r, "fps": 30}) for r in regions + regions[:1]]
    found = sum(store.get_config(own, h)["name"] in regions for h in set(hashes))
    return own.rows().agg(F.count("*").alias("stored")).withColumn("asked", F.lit(found))


@query("SELECT min(s) AS segment FROM (SELECT DISTINCT 'seg' || n_nationkey AS s FROM nation WHERE n_regionkey = 2)")
def segment_by_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").select(F.concat(F.lit("seg"), "n_nationkey").alias("segment"), F.col("n_regionkey").cast("string").alias("config_hash"))
    return store.first_by_config(rows, "2").select("segment")


@query("SELECT format('r{}.json', r_regionkey) AS file, CAST(i AS DOUBLE) AS start, CASE WHEN i = 1 THEN 'pick: it' ELSE 'pick' END AS label FROM region, (SELECT unnest([0, 1]) AS i)")
def annotation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_path(spark, "sidecars")
    for r in table(spark, sf_dir, "region").collect():  # five rows
        marks = [{"skillAtomic": "pick", "startPosition": 0.0, "endPosition": 1.0}, {"skillAtomic": "pick", "enSkillDetail": "it", "startPosition": 1.0, "endPosition": 2.0}]
        _text(spark, root, f"r{r['r_regionkey']}.json", json.dumps({"id": "x", "marks": marks}))
    found = sidecars.segments(sidecars.read_annotations(spark, root))
    return found.select(F.regexp_extract("file", "([^/]+)$", 1).alias("file"), "start", "label")


@query("SELECT r_name AS name, CASE WHEN r_regionkey = 0 THEN 'default' ELSE 'ns' END AS namespace, CAST(r_regionkey AS INTEGER) AS n_sources FROM region")
def manifest_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, jobs = shared_path(spark, "jobs"), []
    for r in table(spark, sf_dir, "region").collect():  # five rows
        job = {"name": r["r_name"], "sources": ["s3://b/x"] * int(r["r_regionkey"]), "output": "s3://b/out"}
        jobs.append(job | ({"namespace": "ns"} if r["r_regionkey"] else {}))
    _text(spark, root, "jobs.json", json.dumps(jobs))
    return sidecars.read_manifest(spark, root).select("name", "namespace", F.size("sources").alias("n_sources"))


@query("SELECT format('r{}.mcap', r_regionkey) AS name, CAST(10 + r_regionkey AS BIGINT) AS size, true AS named FROM region WHERE r_regionkey > 0")
def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings below a prefix in order of path, with sizes and names of work units; other files don't count."""
    root = shared_path(spark, "listing")
    for r in table(spark, sf_dir, "region").collect():  # five rows
        k = int(r["r_regionkey"])
        _save(spark, root, f"r{k}.{'mcap' if k else 'txt'}", bytes(10 + k))
    out = sidecars.list_files(spark, root).orderBy("path")
    return out.select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "size", F.col("id").rlike("^[0-9a-f]{16}$").alias("named"))


_TOML = "[dataset]\nname = 'd'\nfps = 10\n[streaming]\ngap_ns = 5\nmode = 'round'\nrequired = ['a']\n[flushing]\nmax_images = 7\n" + "".join(
    f"[[mappings]]\ntopic = '{t}'\nfeature = '{f}'\nmapping_type = '{k}'\n" for t, f, k in MAPPINGS
)


@query(f"WITH {EV}, map(topic, feature, type) AS (VALUES ('click', 'action.click', 'action'), ('view', 'observation.view', 'state'), ('purchase', 'observation.state', 'state')) SELECT feature, type, count(*) AS n, 10 AS fps, 'round' AS mode, 7 AS flush FROM ev JOIN map USING (topic) GROUP BY ALL")
def toml_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages under a configuration read from TOML."""
    own = config.from_toml(_TOML)
    rows = mapping.mapping_table(spark, [(m.topic, m.feature, m.type) for m in own.mappings])
    out = mapping.renamed(mapping.filtered(event_messages(spark, sf_dir), rows), rows).groupBy("feature", F.col("declared").alias("type")).agg(F.count("*").alias("n"))
    return out.select("feature", "type", "n", F.lit(own.fps).alias("fps"), F.lit(own.mode).alias("mode"), F.lit(own.flush_images).alias("flush"))


_NORM = """[type_mappings]
"shop/view" = "robot/msg/View"
[wildcard_mappings]
"shop/*" = "any.*"
[[topic_type_mappings]]
topic = "/click"
from = "shop/click"
to = "robot.msg.Click"
[[topic_mappings]]
from = "/s*"
to = "/new/s*"
"""


@query("SELECT event_id AS seq, CASE event_type WHEN 'view' THEN 'robot/msg/View' WHEN 'click' THEN 'robot.msg.Click' ELSE 'any.' || event_type END AS type, CASE WHEN event_type LIKE 's%' THEN '/new/' || event_type ELSE '/' || event_type END AS topic FROM events")
def normalized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_messages(spark, sf_dir).select("seq", F.concat(F.lit("shop/"), "topic").alias("type"), F.concat(F.lit("/"), "topic").alias("topic"))
    return normalize_from_toml(_NORM).applied(rows)


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'ros2' WHEN 1 THEN 'ros1' WHEN 2 THEN 'proto' END AS style FROM part")
def type_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    name = F.when(k == 0, F.lit("pkg/msg/T")).when(k == 1, F.lit("pkg/T")).when(k == 2, F.lit("pkg.sub.T")).otherwise(F.lit("9x/T"))
    return table(spark, sf_dir, "part").select("p_partkey", names.type_style(name).alias("style"))


@query("SELECT p_partkey, p_type || ': ' || p_name AS task, 'arm_' || p_partkey AS robot FROM part")
def task_and_robot_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", names.task_text(F.col("p_type"), F.col("p_name")).alias("task"), names.robot_type("arm_", F.col("p_partkey").cast("string")).alias("robot"))


@query("SELECT n_name, 's3' AS scheme, 'bucket' AS bucket, 'a/' || n_nationkey || '.mcap' AS key, 'eu' AS region FROM nation")
def parsed_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Storage URLs of sources, each parsed."""
    rows = []
    for r in _nations(spark, sf_dir):
        u = names.parse_url(f"s3://bucket/a/{r['n_nationkey']}.mcap?region=eu")
        rows.append((r["n_name"], u["scheme"], u["bucket"], u["key"], u["options"]["region"]))
    return spark.createDataFrame(rows, "n_name string, scheme string, bucket string, key string, region string")


# --- message values


@query("SELECT vec_id, CAST(embedding[1] AS DOUBLE) > 0 AS has_k, CASE WHEN embedding[1] > 0 THEN true ELSE false END AS info FROM embeddings")
def camera_info_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = F.get("embedding", F.lit(0)) > 0
    keys = F.when(some, F.array(F.lit("D"), F.lit("K"), F.lit("R"))).otherwise(F.array(F.lit("K"), F.lit("x")))
    return table(spark, sf_dir, "embeddings").select("vec_id", some.alias("has_k"), values.is_camera_info(keys).alias("info"))


@query(f"WITH {EV} SELECT seq, topic = 'click' AS action FROM ev")
def aligner_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The buffered aligner's rule: action is what begins with action."""
    feature = F.when(F.col("topic") == "click", F.lit("action.click")).otherwise(F.concat(F.lit("x.action."), "topic"))
    return event_messages(spark, sf_dir).select("seq", values.is_action_prefix(feature).alias("action"))


@query("SELECT l_orderkey, l_linenumber, CAST(l_discount AS FLOAT) AS a, CAST(l_quantity AS FLOAT) AS b, CAST(l_tax AS FLOAT) AS c FROM lineitem")
def flattened_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All numbers of a message, in order of field names."""
    d = lambda c: F.array(F.col(c).cast("double"))
    fields = F.create_map(F.lit("q"), d("l_quantity"), F.lit("t"), d("l_tax"), F.lit("d"), d("l_discount"))
    out = values.flat_fields(fields)
    at = lambda k: F.get(out, F.lit(k))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", at(0).alias("a"), at(1).alias("b"), at(2).alias("c"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 4 = 0 THEN 'encoded' WHEN l_linenumber % 4 = 1 THEN CASE WHEN l_quantity < 30 THEN 'encoded' WHEN l_quantity = 30 THEN 'rgb' END END AS kind FROM lineitem")
def image_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded by name or by size, raw by size, else no image."""
    k = F.col("l_linenumber") % 4
    side = F.when(k == 1, F.lit(2)).cast("long")
    kind = values.image_kind(F.when(k == 0, F.lit("jpeg")), F.lit(5).cast("long"), side, F.when(k < 2, F.col("l_quantity").cast("long")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", kind.alias("kind"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity * 10 <= 255 THEN '01' || lpad(lower(format('{:x}', CAST(l_quantity * 10 AS BIGINT))), 2, '0') ELSE '01' END AS bytes FROM lineitem")
def bytes_of_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements that fit a byte, of the first nested array that isn't empty."""
    own = F.array(F.lit(-1).cast("double"), F.lit(1).cast("double"), (F.col("l_quantity") * 10).cast("double"))
    found = values.nested_bytes(F.array(F.array().cast("array<double>"), own))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.lower(F.hex(found)).alias("bytes"))


@query("SELECT l_orderkey, l_linenumber, true AS has_q, CAST(l_quantity AS BIGINT) > 20 AS above, l_linenumber > 3 AS longer FROM lineitem")
def field_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.create_map(F.lit("q"), F.col("l_quantity").cast("long").cast("string"))
    arrays = F.create_map(F.lit("a"), F.array_repeat(F.lit(1), F.col("l_linenumber").cast("int")))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", values.field_exists(fields, "q").alias("has_q"), values.field_above(fields, "q", 20).alias("above"), values.field_longer(arrays, "a", 3).alias("longer")
    )


@query(f"WITH {FR} SELECT count(*) FILTER (state IS NOT NULL OR action IS NOT NULL OR frame_index % 2 = 0) AS kept, count(*) AS n FROM fr")
def empty_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with a state, an action or a picture stay."""
    rows = line_frames(spark, sf_dir)
    one = lambda c, some: F.when(some, F.create_map(F.lit("x"), c)).otherwise(F.create_map().cast("map<string,array<float>>"))
    rows = rows.select("frame_index", one(F.col("state"), F.col("state").isNotNull()).alias("states"), one(F.col("action"), F.col("action").isNotNull()).alias("actions"), one(F.array().cast("array<float>"), F.col("frame_index") % 2 == 0).alias("images"))
    return align.not_empty(rows).agg(F.count("*").alias("kept")).crossJoin(rows.agg(F.count("*").alias("n")))


@query(f"WITH {EV} SELECT count(*) FILTER (topic IN ('click', 'view')) AS kept FROM ev")
def bare_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalars and bare bytes contribute nothing: only vectors come through."""
    vector = F.col("topic").isin("click", "view")
    numbers = F.when(vector, F.col("data").cast("array<double>"))
    rows = event_messages(spark, sf_dir).select(values.vector_of(numbers, F.transform(numbers, lambda _: F.lit("float64"))).alias("data"))
    return rows.agg(F.count("data").alias("kept"))


# --- pictures


_HEAD = "FFD8FFE000104A46494600010100000100010000"


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 <> 2 THEN CAST(l_quantity * 20 AS BIGINT) END AS width, CASE WHEN l_linenumber % 3 <> 2 THEN CAST(l_quantity * 10 AS BIGINT) END AS height FROM lineitem")
def jpeg_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes from baseline and progressive JPEG headers behind another segment; an image that ends before is none."""
    two = lambda n: F.lpad(F.hex(n.cast("long")), 4, "0")
    kind = F.element_at(F.array(F.lit("FFC0"), F.lit("FFC2"), F.lit("FFD9")), (F.col("l_linenumber") % 3 + 1).cast("int"))
    body = F.concat(F.lit(_HEAD), kind, F.lit("001108"), two(F.col("l_quantity") * 10), two(F.col("l_quantity") * 20), F.lit("03012200021101031101"))
    size = media.jpeg_size(F.unhex(body))
    return table(spark, sf_dir, "lineitem").withColumn("s", size).select("l_orderkey", "l_linenumber", "s.width", "s.height")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 10 THEN CAST(l_quantity AS BIGINT) END AS width, CASE WHEN l_quantity > 10 THEN 'png' ELSE 'jpeg' END AS format, l_quantity <= 10 AS jpeg, l_quantity > 10 AS png, CASE WHEN l_quantity > 10 THEN 'png' ELSE 'jpeg' END AS found FROM lineitem")
def image_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PNG and JPEG by their bytes, whatever they are called."""
    four = lambda n: F.lpad(F.hex(n.cast("long")), 8, "0")
    png = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), four(F.col("l_quantity")), F.lit("000000F0"))
    data = F.unhex(F.when(F.col("l_quantity") > 10, png).otherwise(F.lit(_HEAD)))
    rows = table(spark, sf_dir, "lineitem").withColumn("d", data)
    d = F.col("d")
    return rows.select(
        "l_orderkey", "l_linenumber", media.png_size(d)["width"].alias("width"), media.image_format(d).alias("format"), media.is_jpeg(d).alias("jpeg"), media.is_png(d).alias("png"), media.detect_format(d, F.lit("bgr8")).alias("found")
    )


@query("SELECT l_orderkey, l_linenumber, ['rgb8', 'bgr8', 'gray8', 'jpeg', 'unknown', 'unknown', 'rgb8'][l_linenumber] AS format FROM lineitem")
def named_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.element_at(F.array(*map(F.lit, ["RGB8", "bgra8", "mono8", "hevc", "x", "", "rgba8"])), F.col("l_linenumber").cast("int"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", media.named_format(name).alias("format"))


_PIX = "p AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) * 4 AS r, CAST(l_linenumber AS INTEGER) * 20 AS g, l_suppkey % 256 AS b FROM lineitem)"


def _pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A picture of 2 x 2 pixels of one colour a line."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity").cast("int") * 4).alias("r"), (F.col("l_linenumber").cast("int") * 20).alias("g"), (F.col("l_suppkey") % 256).alias("b"))
    byte = lambda c: F.lpad(F.hex(F.col(c).cast("long")), 2, "0")
    return rows.withColumn("data", F.unhex(F.repeat(F.concat(byte("r"), byte("g"), byte("b")), F.lit(4))))


def _byte(data: Column, k: int) -> Column:
    return F.conv(F.hex(F.substring(data, k + 1, 1)), 16, 10).cast("int")


_YUV = "(77 * r + 150 * g + 29 * b) >> 8 AS y, ((-43 * r - 85 * g + 128 * b) >> 8) + 128 AS u, ((128 * r - 107 * g - 21 * b) >> 8) + 128 AS v"


@query(f"WITH {_PIX} SELECT l_orderkey, l_linenumber, {_YUV}, 6 AS size FROM p")
def yuv_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pixels(spark, sf_dir).withColumn("o", media.rgb_to_yuv420p(F.col("data"), F.lit(2), F.lit(2)))
    return rows.select("l_orderkey", "l_linenumber", _byte(F.col("o"), 0).alias("y"), _byte(F.col("o"), 4).alias("u"), _byte(F.col("o"), 5).alias("v"), F.octet_length("o").alias("size"))


@query(f"WITH {_PIX} SELECT l_orderkey, l_linenumber, {_YUV} FROM p")
def nv12_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pixels(spark, sf_dir).withColumn("o", media.rgb_to_nv12(F.col("data"), F.lit(2), F.lit(2)))
    return rows.select("l_orderkey", "l_linenumber", _byte(F.col("o"), 3).alias("y"), _byte(F.col("o"), 4).alias("u"), _byte(F.col("o"), 5).alias("v"))


@query(f"WITH {_PIX} SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN r ELSE g END AS first, CASE WHEN l_linenumber % 2 = 0 THEN 9 ELSE 18 END AS size FROM p")
def colours_to_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RGBA loses alpha; 16-bit grey keeps its high byte three times."""
    even = F.col("l_linenumber") % 2 == 0
    rows = _pixels(spark, sf_dir).withColumn("o", media.to_rgb8(F.when(even, F.col("data")).otherwise(F.unhex(F.repeat(F.concat(F.lit("00"), F.lpad(F.hex(F.col("g").cast("long")), 2, "0")), F.lit(6)))), F.when(even, F.lit("rgba8")).otherwise(F.lit("l16"))))
    return rows.select("l_orderkey", "l_linenumber", _byte(F.col("o"), 0).alias("first"), F.octet_length("o").alias("size"))


@query(f"WITH {_PIX} SELECT l_orderkey, l_linenumber, l_linenumber = 3 AS ok FROM p")
def valid_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw frame is valid at exactly its layout's size."""
    size = F.octet_length("data") * F.when(F.col("l_linenumber") == 3, 1).otherwise(2)
    return _pixels(spark, sf_dir).select("l_orderkey", "l_linenumber", media.frame_is_valid(F.lit("rgb24"), F.lit(2), F.lit(2), size.cast("long")).alias("ok"))


_IMGS = "im AS (SELECT l_suppkey AS episode_index, l_orderkey * 10000 + l_partkey * 8 + l_linenumber AS frame_index FROM lineitem)"


@query(f"WITH {_IMGS}, f AS (SELECT episode_index, (row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1) // 21 AS fragment FROM im) SELECT episode_index, CAST(fragment AS BIGINT) AS fragment, count(*) AS frames FROM f GROUP BY 1, 2")
def fragments_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments full at 2,050 bytes of frames of 100, before 60 frames or 1.5 seconds."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("episode_index"), (F.col("l_orderkey") * 10000 + F.col("l_partkey") * 8 + F.col("l_linenumber")).alias("frame_index"), F.lit(100).cast("long").alias("size"))
    out = video.fragments_by_bytes(rows, ["episode_index"], "frame_index", 60, 2050, 1.5, 30)
    return out.groupBy("episode_index", "fragment").agg(F.count("*").alias("frames"))


@query("SELECT CAST(l_suppkey AS BIGINT) AS episode_index, 'cam' AS camera, count(*) AS frames, format('videos/chunk-{:03d}/cam/episode_{:06d}.mp4', l_suppkey // 500, l_suppkey) AS path FROM lineitem GROUP BY l_suppkey")
def video_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("long").alias("episode_index"), F.lit("cam").alias("camera"), F.col("l_orderkey").alias("frame_index"), F.lit(4).alias("width"), F.lit(2).alias("height"), F.col("l_orderkey").alias("timestamp_ns")
    )
    return video.manifest(video.sized(rows, ["episode_index", "camera"])).select("episode_index", "camera", "frames", "path")


@query("SELECT * FROM (VALUES ('balanced', 'medium', 23), ('prototype', 'ultrafast', 32), ('quality', 'slow', 18), ('speed', 'ultrafast', 28), ('storage', 'slow', 28)) t(profile, preset, crf)")
def encoder_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(p, *config.Config("x", profile=p).encoder()) for p in config.PROFILES]
    return spark.createDataFrame(rows, "profile string, preset string, crf int")


@query("SELECT CAST(n_nationkey AS INTEGER) AS images, n_nationkey >= 7 OR n_nationkey * 10 >= 50 AS flush FROM nation")
def flush_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = config.Config("x", flush_images=7, flush_bytes=50)
    rows = [(int(r["n_nationkey"]), own.should_flush(int(r["n_nationkey"]), int(r["n_nationkey"]) * 10)) for r in _nations(spark, sf_dir)]
    return spark.createDataFrame(rows, "images int, flush boolean")


# --- control, counts, hooks


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 IN (0, 1) THEN 'Cancelled' WHEN o_orderkey % 4 = 2 THEN 'Complete' ELSE 'Suspended' END AS phase FROM orders")
def cancelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    phase = F.element_at(F.array(*map(F.lit, ["Pending", "Merging", "Complete", "Suspended"])), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), control.after_cancel(phase).alias("phase"))


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'P' AND o_custkey % 7 >= 3")
def merge_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "P", F.lit("Pending")).otherwise(F.lit("Complete")).alias("status"), (F.col("o_custkey") % 7).alias("completed"), F.lit(3).alias("expected"))
    return control.merge_ready(rows).select("id")


@query("SELECT l_orderkey, l_linenumber, l_quantity >= 40 OR l_linenumber >= 5 AS due FROM lineitem")
def checkpoints_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", control.checkpoint_due(F.col("l_quantity"), F.col("l_linenumber"), 40, 5.0).alias("due"))


@query("SELECT o_orderkey AS id, o_orderkey % 3 + o_orderkey % 2 >= o_custkey % 5 AS done, CASE WHEN o_custkey % 5 = 0 THEN 0 ELSE (o_orderkey % 3 + o_orderkey % 2) * 100.0 / (o_custkey % 5) END AS percent FROM orders")
def upload_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, total = F.col("o_orderkey"), F.col("o_custkey") % 5
    return table(spark, sf_dir, "orders").select(key.alias("id"), control.upload_complete(key % 3, key % 2, total).alias("done"), control.files_progress(key % 3, key % 2, total).alias("percent"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 + o_custkey % 4 = 0 THEN 0 ELSE (o_custkey % 4) / (o_orderkey % 3 + o_custkey % 4) END AS share, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE (o_custkey % 4) / (o_orderkey % 3) END AS average FROM orders")
def rate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of tasks found again, and mean time of a registration."""
    new, again = F.col("o_orderkey") % 3, F.col("o_custkey") % 4
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), stats.share(again, new).alias("share"), stats.average(again, new).alias("average"))


@query("SELECT count(*) AS episodes, CAST(sum(n) AS BIGINT) AS frames, min(k) AS first, max(k) AS last, CAST(sum(n) // count(*) AS BIGINT) AS average FROM (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)")
def dataset_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.overview(table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("episode_index")).agg(F.count("*").alias("length")))


@query(f"WITH {UN} SELECT id, batch FROM un WHERE status = 'Pending' AND batch = 3 ORDER BY id LIMIT 100")
def listed_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _units(spark, sf_dir).withColumnRenamed("status", "phase").withColumn("namespace", F.col("batch").cast("string"))
    return control.listed(rows, phase="Pending", namespace="3").select("id", "batch")


@query("SELECT l_orderkey AS episode_index, l_linenumber AS frame_index, l_quantity * 2 AS twice, l_linenumber <> 2 AS should_write FROM lineitem")
def processed_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A processor on batches of frames adds a column and says what not to write."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("episode_index"), F.col("l_linenumber").alias("frame_index"), F.col("l_quantity").cast("double").alias("q"))
    out = process.processed(rows, lambda b: b.assign(twice=b["q"] * 2, should_write=b["frame_index"] != 2), "twice double, should_write boolean")
    return out.drop("q")


class _Numbering(process.Hooks):
    def start(self, episode) -> None:
        self.name, self.seen = f"e{episode}", 0

    def process(self, frames):
        self.seen += len(frames)
        return frames.assign(name=self.name, place=range(self.seen - len(frames), self.seen))


@query("SELECT CAST(l_suppkey AS BIGINT) AS episode_index, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS frame_index, 'e' || l_suppkey AS name, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey * 10 + l_linenumber) - 1 AS BIGINT) AS place FROM lineitem")
def episode_hooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A processor that is started for each episode, over all lines."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("long").alias("episode_index"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("frame_index"))
    return process.per_episode(rows, _Numbering, "name string, place long")


@query("SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS INTEGER) AS size FROM lineitem")
def transformed_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    out = process.transformed(rows, lambda b: [bytes(n) for n in b["l_linenumber"]])
    return out.select("l_orderkey", "l_linenumber", F.octet_length("bytes").alias("size"))


@query("SELECT count(*) AS frames, count(*) FILTER (l_linenumber <> 2) AS written, count(*) FILTER (l_linenumber = 2) AS skipped, count(*) FILTER (l_linenumber <> 2) / count(*) AS success_rate FROM lineitem")
def processor_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process.processor_stats(processed_frames(spark, sf_dir))


@query(f"WITH {FR}, w AS (SELECT episode_index, max(len(state)) AS ws FROM fr GROUP BY 1) SELECT 'state' AS feature, CAST(max(ws) AS INTEGER) AS width FROM w")
def consistent_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features whose episodes agree on their width."""
    found = stats.episode_stats(line_frames(spark, sf_dir), ["episode_index"], {"state": "state"})
    return stats.consistent(found).select("feature", F.col("width").cast("int").alias("width"))


@query("SELECT l_orderkey AS episode_index, 'frame_index' AS fault FROM (SELECT l_orderkey, l_linenumber - 1 AS f, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS p FROM lineitem WHERE l_linenumber <> 3) GROUP BY 1 HAVING bool_or(f <> p)")
def frame_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes whose frame numbers have holes."""
    rows = table(spark, sf_dir, "lineitem").where("l_linenumber <> 3").select(F.col("l_orderkey").alias("episode_index"), (F.col("l_linenumber") - 1).cast("long").alias("frame_index"), F.lit(0.0).alias("timestamp"))
    return validate.frame_invariants(rows)


@query("SELECT 'gap' AS kind, CAST(0 AS BIGINT) AS episode, CAST(10 AS BIGINT) AS n UNION ALL SELECT 'gap', 1, 15 UNION ALL SELECT 'error', NULL, NULL UNION ALL SELECT 'count', 0, 25")
def mock_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generators: a gap makes an episode, and one fails at a message."""
    gap = with_gap(counted(spark, 25), 10, 10**12)
    rows = episodes.by_gap(gap, 10**11, ["source"], ["seq"]).groupBy("episode").agg(F.count("*").alias("n")).select(F.lit("gap").alias("kind"), "episode", "n")
    try:
        failing(counted(spark, 25), 20).agg(F.sum("seq")).collect()
        kind = "none"
    except Exception as e:
        kind = "error" if "message 20" in str(e) else "other"
    more = spark.createDataFrame([(kind, None, None), ("count", 0, counted(spark, 25).count())], "kind string, episode long, n long")
    return rows.unionByName(more)


@query("SELECT conv_id AS episode_index, count(*) - 1 - max(turn) <> 0 AS hole FROM conversations WHERE turn <> 1 GROUP BY 1 HAVING hole")
def conversation_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as episodes of turns: those whose numbers have holes."""
    rows = table(spark, sf_dir, "conversations").where("turn <> 1").select(F.col("conv_id").alias("episode_index"), F.col("turn").cast("long").alias("frame_index"), F.lit(0.0).alias("timestamp"))
    return validate.frame_invariants(rows).select("episode_index", F.lit(True).alias("hole"))
