"""Mixing sources to target weights, in DataFrame expressions only.

Each source's documents, in an order set by a hash, form one stream of words that is cut into blocks of `block` words.
The mix is a list of slots, dealt to output shards of `shard_slots`. A shard's slots draw their sources at random with
probabilities in proportion to the targets, which makes a shard's source counts multinomial. Slots that a source draws
beyond its quota go to sources that drew too few, so that every source fills its quota exactly. A source's t-th slot
takes the block at place t of a pseudorandom permutation of the source's blocks (swap-or-not rounds, which permute
any 0..n-1 without a table); each further pass over the blocks uses another permutation. Slots meet blocks in a join on
(source, block).

Nothing is ordered or numbered in one task: stream positions come from sums per (source, hash bucket) and a running
sum inside each bucket, and a source's slots from sums per run of shards and a running sum inside each run. Only the list of sources, a row each, comes to the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelake.llm.common import WORD, stored

WEIGHTS = (5, 2, 1)
ROUNDS = 10
#: Slots that one task places.
TASK_SLOTS = 100_000
#: Shards whose draws are added up in one window.
RUN = 1024


@dataclass
class Mix:
    rows: DataFrame  # the carried columns and __h, __h2 (hashes of all columns), __sid, __size, __start, __source_size, __target
    slots: DataFrame  # shard, place, sid, pass, block
    block: int


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: tuple = WEIGHTS, share: float = 1.5, most: float = 2.0) -> list[float]:
    """share of all sizes dealt by weight; a target stops at `most` times its size, and what is over is dealt again."""
    w = [weights[k % len(weights)] for k in range(len(sizes))]
    total, out, free = share * sum(sizes), [0.0] * len(sizes), list(range(len(sizes)))
    while free:
        left = total - sum(most * sizes[k] for k in set(range(len(sizes))) - set(free))
        unit = left / sum(w[k] for k in free)
        above = [k for k in free if unit * w[k] > most * sizes[k]]
        for k in free:
            out[k] = most * sizes[k] if k in above else unit * w[k]
        if not above:
            break
        free = [k for k in free if k not in above]
    return out


def mix(
    df: DataFrame, text: str = "text", source: str = "source", block: int = 64, shard_slots: int = 4096, buckets: int = 1024, seed: int = 11,
    weights: tuple = WEIGHTS, share: float = 1.5, most: float = 2.0, carry: list[str] | None = None,
) -> Mix:
    """The mix of df's rows. Null texts have no words; a null source is a source of its own, the last one.

    Repeated rows are rows of their own. Columns of df that are named as the mix's own (two leading underscores) are
    replaced. The result depends on the rows alone, not on their order or partitions. carry names the columns that go
    on to the mix's rows, all unless given; the order inside a source is set by a hash of all columns in any case.
    """
    spark = df.sparkSession
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith("__")])
    every = [F.col(f"`{c}`") for c in df.columns]
    rows = _hashed(df, seed).withColumn("__size", size_of(F.col(text)))
    carried = df.columns if carry is None else [c for c in df.columns if c in carry]
    every = [F.col(f"`{c}`") for c in carried]
    rows = rows.select(*every, "__size", "__h", "__h2")
    rows, _ = stored(rows, "sized")
    own = rows.groupBy(F.col(source).alias("source")).agg(F.sum("__size").alias("size")).collect()  # a row per source
    own = sorted(((r["source"], r["size"]) for r in own), key=lambda r: (r[0] is None, (r[0] or "").encode()))
    want = targets([n for _, n in own], weights, share, most)
    listed = []
    for k, ((name, size), target) in enumerate(zip(own, want, strict=True)):
        n = -(-size // block)
        listed.append((k, name, size, target, n, min(int(most * n), round(target * n / size)) if size else 0))
    sources = spark.createDataFrame(listed, "__sid int, __source string, __source_size long, __target double, __n long, __quota long")
    named = rows.join(sources.drop("__n", "__quota"), F.col(source).eqNullSafe(F.col("__source"))).drop("__source")
    named = named.withColumn("__bucket", F.pmod("__h", F.lit(buckets)))
    sums = named.groupBy("__sid", "__bucket").agg(F.sum("__size").alias("__sum"))
    before = Window.partitionBy("__sid").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases, _ = stored(sums.select("__sid", "__bucket", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base")), "bases")
    inside = Window.partitionBy("__sid", "__bucket").orderBy("__h", "__h2").rowsBetween(Window.unboundedPreceding, -1)
    placed = named.withColumn("__in", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
    placed = placed.join(bases, ["__sid", "__bucket"]).withColumn("__start", F.col("__base") + F.col("__in"))
    placed, _ = stored(placed.select(*every, "__h", "__h2", "__sid", "__size", "__start", "__source_size", "__target"), "placed")
    return Mix(placed, _slots(spark, sources, listed, shard_slots, seed), block)


def _hashed(df: DataFrame, seed: int) -> DataFrame:
    """df with 128 bits that name a row by its content; rows that agree in all columns share them."""
    every = [F.col(f"`{c}`") for c in df.columns]
    return df.withColumns({"__h": F.xxhash64(F.lit(seed), *every), "__h2": F.xxhash64(F.lit(seed + 1), *every)})


def _stride(n: int) -> int:
    """A factor that permutes 0..n-1 and takes neighbours far apart; no product with it overflows 63 bits."""
    k = max(1, min(int(0.618 * n), (1 << 62) // max(n, 1)))
    while math.gcd(k, n) > 1:
        k -= 1
    return k


def _draw(listed: list, total: int, key: Column) -> Column:
    """Index of the source in whose part of 0..total-1 a hash falls."""
    ends, at = [], 0
    for row in listed:
        ends.append(at := at + row[5])
    return F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e <= F.pmod(key, F.lit(total))))


def _slots(spark, sources: DataFrame, listed: list, shard_slots: int, seed: int) -> DataFrame:
    total = sum(row[5] for row in listed)
    drawn = spark.range(total).select(
        F.expr(f"id div {shard_slots}").alias("shard"), _draw(listed, total, F.xxhash64(F.lit(seed), F.lit("slot"), "id")).alias("__sid") if total else F.lit(0).alias("__sid")
    )
    counts, _ = stored(drawn.groupBy("shard", "__sid").agg(F.count("*").alias("n")), "counts")
    # what a source drew beyond its quota, dealt in order to what others lack; slots are numbered by strides, so that what is
    # dealt anew is spread over all shards and leaves each one's counts nearly as drawn
    got = {r["__sid"]: r["n"] for r in counts.groupBy("__sid").agg(F.sum("n").alias("n")).collect()}
    over, lack, a, b = {}, [], 0, 0
    for row in listed:
        n, quota = got.get(row[0], 0), row[5]
        if n > quota:
            over[row[0]] = a
            a += n - quota
        elif n < quota:
            lack.append((b, row[0], n))
            b += quota - n
    # running sums over runs of RUN shards, and inside each run: no task has a source's shards all together
    counts = counts.withColumn("run", F.expr(f"shard div {RUN}"))
    runs = counts.groupBy("__sid", "run").agg(F.sum("n").alias("all"))
    upto = Window.partitionBy("__sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs, _ = stored(runs.select("__sid", "run", F.coalesce(F.sum("all").over(upto), F.lit(0)).alias("before")), "runs")
    inside = Window.partitionBy("__sid", "run").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = counts.withColumn("in", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(runs, ["__sid", "run"])
    based = based.withColumn("base", F.col("before") + F.col("in"))
    # by number, so that the few rows before the explosion do not end up in one task
    based = based.repartition(max(1, -(-total // TASK_SLOTS)), "shard", "__sid")
    slots = based.select("shard", "__sid", F.explode(F.sequence(F.col("base"), F.col("base") + F.col("n") - 1)).alias("t"))
    strides = F.array(*[F.lit(_stride(got.get(r[0], 0))).cast("long") for r in listed])
    drawn_of = F.array(*[F.lit(max(1, got.get(r[0], 0))).cast("long") for r in listed])
    at = F.col("__sid") + 1
    if over:
        slots = slots.withColumn("t", F.pmod(F.col("t") * F.element_at(strides, at), F.element_at(drawn_of, at)))
        quota = F.element_at(F.array(*[F.lit(r[5]).cast("long") for r in listed]), F.col("__sid") + 1)
        first = F.element_at(F.array(*[F.lit(over.get(r[0], 0)).cast("long") for r in listed]), F.col("__sid") + 1)
        place = first + F.col("t") - quota
        to = F.lit(None).cast("struct<sid:int,t:bigint>")
        for begin, sid, n in lack:  # the last part that begins at or before the place
            here = F.struct(F.lit(sid).alias("sid"), (place - begin + n).cast("bigint").alias("t"))
            to = F.when(place < begin, to).otherwise(here)
        slots = slots.select("shard", F.when(F.col("t") < quota, F.struct(F.col("__sid").alias("sid"), F.col("t"))).otherwise(to).alias("s"))
        slots = slots.select("shard", F.col("s.sid").alias("__sid"), F.col("s.t").alias("t"))
    slots = slots.join(F.broadcast(sources.select("__sid", "__n")), "__sid")  # a row a source
    key = f"{seed}, __sid, t div __n"
    turn = f"pmod(xxhash64({key}, r) - x, __n)"
    block = F.expr(
        f"aggregate(sequence(1, {ROUNDS}), t % __n, (x, r) -> IF(xxhash64({key}, r, greatest(x, {turn})) & 1 = 1, {turn}, x))"
    )
    return slots.select("shard", F.xxhash64(F.lit(seed), "shard", "__sid", "t").alias("place"), F.col("__sid").alias("sid"), F.expr("t div __n").alias("pass"), block.alias("block"))


def taken(m: Mix) -> DataFrame:
    """m's rows with __taken: the words the mix takes of each, repeats counted."""
    used = m.slots.groupBy("sid", "block").agg(F.count("*").alias("times"))
    size = m.block
    parts = m.rows.where("__size > 0").select(
        "__sid", "__start", "__size", F.explode(F.expr(f"sequence(__start div {size}, (__start + __size - 1) div {size})")).alias("block")
    )
    words = F.least(F.col("__start") + F.col("__size"), (F.col("block") + 1) * size) - F.greatest("__start", F.col("block") * size)
    used = used.withColumnRenamed("sid", "__sid").hint("merge")  # grows with the mix: never to be broadcast on a guess of its size
    sums = parts.join(used, ["__sid", "block"]).groupBy("__sid", "__start").agg(F.sum(words * F.col("times")).alias("__taken"))
    some = m.rows.where("__size > 0").join(sums, ["__sid", "__start"], "left")
    none = m.rows.where("__size = 0").withColumn("__taken", F.lit(None).cast("long"))
    return some.unionByName(none).withColumn("__taken", F.coalesce("__taken", F.lit(0).cast("long")))


def mixed_documents(df: DataFrame, text: str = "text", source: str = "source", n_chars: str = "n_chars", seed: int = 11, **options) -> DataFrame:
    """The mix of df as documents: a row for each document and pass that takes words of it.

    A text keeps the words of its taken blocks, in order, with the blanks that follow them; one that is taken whole stays
    as it is. n_chars, if the column is there, is set anew. Documents without words are no part of a mix. The mix is made
    on narrow rows; texts are shuffled once, to meet what is taken of them.
    """
    own = [c for c in df.columns if not c.startswith("__")]
    m = mix(df, text, source, seed=seed, carry=[source], **options)
    size = m.block
    parts = m.rows.where("__size > 0").select(
        "__h", "__h2", "__start", "__sid", "__size", F.explode(F.expr(f"sequence(__start div {size}, (__start + __size - 1) div {size})")).alias("block")
    )
    lo = F.greatest("__start", F.col("block") * size) - F.col("__start")
    hi = F.least(F.col("__start") + F.col("__size"), (F.col("block") + 1) * size) - F.col("__start")
    parts = parts.withColumn("part", F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi")))
    taken = parts.join(m.slots.select(F.col("sid").alias("__sid"), "pass", "block").hint("merge"), ["__sid", "block"])
    taken = taken.groupBy("__h", "__h2", "__size", "__start", "pass").agg(F.array_sort(F.collect_list("part")).alias("__parts"))
    taken, _ = stored(taken, "taken")
    texts = _hashed(df.select(*[F.col(f"`{c}`") for c in own]), seed).dropDuplicates(["__h", "__h2"])
    rows = texts.join(taken.hint("merge"), ["__h", "__h2"])
    n = F.aggregate("__parts", F.lit(0), lambda a, p: a + p["hi"] - p["lo"])
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)"), F.lit(1))
    cut = F.array_join(F.flatten(F.transform("__parts", lambda p: F.slice(F.col("__words"), p["lo"] + 1, p["hi"] - p["lo"]))), "")
    rows = rows.withColumn("__words", F.when(n < F.col("__size"), words)).withColumn("__text", F.when(F.col("__words").isNull(), F.col(f"`{text}`")).otherwise(cut))
    new = {text: F.col("__text")} | ({n_chars: F.length("__text").cast(df.schema[n_chars].dataType)} if n_chars in own else {})
    return rows.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in own])
