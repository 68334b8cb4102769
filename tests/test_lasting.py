"""What lasts over runs: task indices, and the log of converted files."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from framelake.operators import dictionary
from framelake.operators.dictionary import TaskDictionary
from framelake.plans import incremental
from framelake.shared import made_new, shared_path
from framelake.sources import lake


def test_indices_stay(spark):
    own = TaskDictionary(spark, shared_path(spark, "tasks"))
    assert own.tasks().count() == 0
    rows = lambda *t: spark.createDataFrame(list(enumerate(t)), "n int, task string")
    assert own.extend(rows("b", "a", None, "b"), "task", ["n"]) == 2
    assert own.extend(rows("a", "z", "c"), "task", ["n"]) == 2
    assert own.extend(rows("z", None), "task", ["n"]) == 0 and own.extend(rows().limit(0), "task", ["n"]) == 0
    key = lambda df: {r["task"]: r["task_index"] for r in df.collect()}
    assert key(own.tasks()) == {"b": 0, "a": 1, "z": 2, "c": 3} and key(own.tasks(1)) == {"b": 0, "a": 1}


def test_runs_at_once_give_no_index_twice(spark):
    path = shared_path(spark, "tasks")

    def run(k):
        rows = spark.range(30).select("id", F.concat(F.lit("t"), ((F.col("id") * 7 + k * 11) % 50).cast("string")).alias("task"))
        return TaskDictionary(spark, path).extend(rows, "task", ["id"])

    with ThreadPoolExecutor(4) as pool:
        added = sum(pool.map(run, range(4)))
    found = TaskDictionary(spark, path).tasks().collect()
    assert len({r["task"] for r in found}) == len(found) == added
    assert sorted(r["task_index"] for r in found) == list(range(len(found)))


def test_a_mark_that_is_taken(spark, monkeypatch):
    path = shared_path(spark, "tasks")
    first, other = TaskDictionary(spark, path), TaskDictionary(spark, path)
    rows = lambda *t: spark.createDataFrame(list(enumerate(t)), "n int, task string")
    publish, tries = TaskDictionary._publish, []

    def late(self, version, mark):
        if not tries:
            tries.append(version)
            monkeypatch.setattr(dictionary.TaskDictionary, "_publish", publish)
            other.extend(rows("x", "y"), "task", ["n"])
        return publish(self, version, mark)

    monkeypatch.setattr(dictionary.TaskDictionary, "_publish", late)
    assert first.extend(rows("y", "w"), "task", ["n"]) == 1
    assert {r["task"]: r["task_index"] for r in first.tasks().collect()} == {"x": 0, "y": 1, "w": 2}


def test_files_are_converted_once(spark):
    root = shared_path(spark, "converted")
    files = lambda *f: spark.createDataFrame(list(f), incremental.FILE)
    convert = lambda todo: todo.select("path", F.explode(F.sequence(F.lit(1), F.col("length"))).alias("n"))
    a, b, c = ("a", 2, 1), ("b", 1, 1), ("c", 3, 2)
    assert incremental.run(files(a, b, a), root, convert) == 2
    assert incremental.run(files(a, b), root, convert) == 0

    def fails(todo):
        return convert(todo).withColumn("n", F.when(F.col("n") == 2, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("n")))

    with pytest.raises(Exception, match="stop"):
        incremental.run(files(a, b, c), root, fails)
    assert incremental.run(files(a, b, c, ("a", 4, 9)), root, convert) == 2  # a file that was written anew is another one
    rows = sorted((r["path"], r["n"]) for r in lake.load(spark, root).collect())
    assert rows == sorted([("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 2), ("c", 3), *[("a", n) for n in (1, 2, 3, 4)]])
    assert lake.load(spark, root, incremental.FILE, lake.INPUTS).count() == 4


def test_one_of_many_makes_a_file(spark):
    path = shared_path(spark, "marks")
    for k in range(20):
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda n, k=k: n if made_new(spark, f"{path}/{k}", str(n)) else None, range(8)))
        won = [n for n in won if n is not None]
        assert len(won) == 1 and open(f"{path.removeprefix('file://')}/{k}").read() == str(won[0])


def test_pending_files_are_looked_up_once(spark):
    """Counting, converting and logging read one table of pending files."""
    from pyspark.sql import functions as F

    from framelake.plans import incremental
    from framelake.shared import shared_path

    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    files = spark.range(40).select(F.col("id").cast("string").alias("path"), F.col("id").alias("length"), F.lit(1).cast("long").alias("modified")).mapInArrow(look, incremental.FILE)
    root = shared_path(spark, "once")
    assert incremental.run(files, root, lambda todo: todo.select("length")) == 40 and seen.value == 40
    assert incremental.run(files, root, lambda todo: todo.select("length")) == 0
