from pyspark.sql import functions as F

from framelake.streaming import aligner

BASE = 1_700_000_000_000_000_000  # a stream begins at the epoch, and rows of that instant count as late
SCHEMA = "source long, feature string, seq long, event_time timestamp, log_time_ns long, data array<float>"


def messages(spark, n=60):
    rows = spark.range(n).withColumn("log_time_ns", F.lit(BASE) + F.col("id") * 4_000_000)
    return rows.select(
        (F.col("id") % 2).alias("source"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("feature"),
        F.col("id").alias("seq"), F.timestamp_micros(F.expr("log_time_ns div 1000")).alias("event_time"), "log_time_ns", F.array(F.col("id").cast("float")).alias("data"),
    )


def run(spark, parts, tmp_path, name, required):
    path = str(tmp_path / name)
    for k, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    q = aligner.aligned(stream, 0, required, interval=20_000_000).writeStream.format("memory").queryName(name).outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.table(name)


def test_stream_equals_batch(spark, tmp_path):
    """Ordered input; nothing completes early, as no frame has the feature that is required."""
    m = messages(spark)
    late = m.withColumn("seq", F.col("seq") + 10_000).withColumn("log_time_ns", F.col("log_time_ns") + 10**9).withColumn("event_time", F.timestamp_micros(F.expr("log_time_ns div 1000")))
    got = run(spark, [m, late.where("seq < 10003"), late.where("seq = 10003")], tmp_path, "closed", ["zz"])
    cols = ["source", "bucket_ns", "features", "data", "n_messages", "complete"]
    want = aligner.batch_aligned(m, 0, ["zz"], interval=20_000_000).select(cols)
    key = lambda r: (r["source"], r["bucket_ns"])
    found = sorted((r for r in got.select(cols).collect() if r["bucket_ns"] < BASE + 10**9), key=key)
    assert found == sorted(want.collect(), key=key)


def test_complete_frames_leave_early(spark, tmp_path):
    got = run(spark, [messages(spark, 30)], tmp_path, "early", ["a"]).where("complete").collect()
    assert got and all("a" in r["features"] for r in got)
