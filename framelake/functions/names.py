"""Feature names, ids, paths and URLs."""

from __future__ import annotations

import re
from urllib.parse import parse_qs, urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What the command line may not hold in a batch id.
MAX_BATCH_ID = 1024
BATCH_ID = r"^[a-z0-9.-]+:[a-z0-9.-]+$"


def feature_of(topic: Column) -> Column:
    """`/a/b` is `a.b`: slashes become dots, and leading dots go."""
    return F.ltrim(F.translate(topic, "/", "."), F.lit("."))


def chunk_of(episode: Column, per_chunk: int = 500) -> Column:
    return F.floor(episode / per_chunk).cast("long")


def parquet_path(episode: Column, per_chunk: int = 500) -> Column:
    return F.format_string("data/chunk-%03d/episode_%06d.parquet", chunk_of(episode, per_chunk), episode.cast("long"))


def video_path(episode: Column, camera: Column, per_chunk: int = 500) -> Column:
    return F.format_string("videos/chunk-%03d/%s/episode_%06d.mp4", chunk_of(episode, per_chunk), camera, episode.cast("long"))


def rlds_video_path(episode: Column, camera: Column) -> Column:
    return F.format_string("episode_%06d/%s.mp4", episode.cast("long"), camera)


def flat_video_path(episode: Column, camera: Column) -> Column:
    return F.format_string("episode_%06d_%s.mp4", episode.cast("long"), camera)


def episode_in(path: Column) -> Column:
    """Number after `episode_` in a file name; 0 where there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(path, r"episode_([0-9]{1,18})", 1), F.lit("")).cast("long"), F.lit(0).cast("long"))


def batch_id_ok(ident: Column) -> Column:
    return F.coalesce((F.length(ident) <= MAX_BATCH_ID) & ident.rlike(BATCH_ID), F.lit(False))


def source_ok(url: Column) -> Column:
    """Any URL with a scheme and a path; a bare or single-slash one is refused."""
    return F.coalesce(url.rlike(r"^(s3|s3a|oss|gs|abfss?|hdfs|file)://.+"), F.lit(False))


def spec_error(name: Column, sources: Column, output: Column) -> Column:
    """First fault of a batch specification, or null."""
    bad = F.exists(sources, lambda u: ~source_ok(u))
    return F.when(F.coalesce(F.trim(name), F.lit("")) == "", F.lit("empty name")).when(
        F.coalesce(F.size(sources), F.lit(0)) <= 0, F.lit("no sources")
    ).when(bad, F.lit("bad source url")).when(~source_ok(output), F.lit("bad output url"))


def unit_id(path: Column, size: Column, config: Column) -> Column:
    """16 hex digits that name a file under a configuration."""
    return F.lpad(F.lower(F.hex(F.xxhash64(path, size, config))), 16, "0")


def type_style(name: Column) -> Column:
    """ros2 (`pkg/msg/Type`), ros1 (`pkg/Type`), proto (`pkg.Type`), else null."""
    part = "[A-Za-z][A-Za-z0-9_]*"
    return F.when(name.rlike(f"^{part}/(msg|srv|action)/{part}$"), F.lit("ros2")).when(name.rlike(f"^{part}/{part}$"), F.lit("ros1")).when(
        name.rlike(rf"^{part}(\.{part})+$"), F.lit("proto")
    )


def task_text(skill: Column, detail: Column) -> Column:
    return F.concat(skill, F.lit(": "), detail)


def robot_type(prefix: str, serial: Column) -> Column:
    """Robot family and device number."""
    return F.concat(F.lit(prefix), serial)


def parse_url(url: str) -> dict:
    """scheme, bucket, key and options of `file://`, `s3://bucket/key?endpoint=&region=` or a bare path."""
    if re.match(r"^s3:/(?!/)", url):
        raise ValueError(f"{url}: s3 needs two slashes")
    parts = urlsplit(url)
    if not parts.scheme:
        return {"scheme": "file", "bucket": None, "key": url, "options": {}}
    if parts.scheme == "file":
        return {"scheme": "file", "bucket": None, "key": parts.path, "options": {}}
    if not parts.netloc:
        raise ValueError(f"{url}: no bucket")
    return {"scheme": parts.scheme, "bucket": parts.netloc, "key": parts.path.lstrip("/"), "options": {k: v[-1] for k, v in parse_qs(parts.query).items()}}
