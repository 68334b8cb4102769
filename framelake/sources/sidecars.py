"""Files beside recordings: annotations, job manifests, listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions.names import task_text, unit_id

MARKS = "array<struct<taskId:string,markStart:string,markEnd:string,duration:double,startPosition:double,endPosition:double,skillAtomic:string,skillDetail:string,enSkillDetail:string,markType:string>>"
ANNOTATION = f"struct<id:string,deviceSn:string,sceneCode:string,sceneName:string,taskCode:string,taskName:string,marks:{MARKS}>"


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """One row a sidecar; the fields named in ANNOTATION, and the file."""
    raw = spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_path"))
    return raw.select("file", F.from_json("value", ANNOTATION).alias("a")).select("file", "a.*")


def segments(annotations: DataFrame) -> DataFrame:
    """(file, start, end, label) a mark, in order of its start."""
    marks = annotations.select("file", F.explode("marks").alias("m"))
    label = F.coalesce(task_text(F.col("m.skillAtomic"), F.col("m.enSkillDetail")), F.col("m.skillAtomic"))
    return marks.select("file", F.col("m.startPosition").alias("start"), F.col("m.endPosition").alias("end"), label.alias("label"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Jobs of a JSON list: (name, namespace, sources, output)."""
    kind = "array<struct<name:string,namespace:string,sources:array<string>,output:string>>"
    raw = spark.read.text(path, wholetext=True)
    jobs = raw.select(F.explode(F.from_json("value", kind)).alias("j")).select("j.*")
    return jobs.withColumn("namespace", F.coalesce("namespace", F.lit("default")))


def list_files(spark: SparkSession, root: str, config: str = "") -> DataFrame:
    """(path, size, modified_at, id) of recordings below root; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified_at"))
    files = files.where(F.lower("path").rlike(r"\.(mcap|bag|rrd)$"))
    return files.withColumn("id", unit_id(F.col("path"), F.col("size"), F.lit(config)))
