"""A task dictionary that lasts: indices stay as they are, new tasks follow in order of appearance.

A version is a table of the tasks that were new in it, and a mark that names the table and how many tasks there are now.
Marks are numbered, and a mark is made only where there is none. Of two runs at once, one makes the next mark; the other
finds it taken, drops its table, and numbers what is still new for it behind the other's. So no index is given twice, and
a run that fails leaves a table that no mark names.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators.episodes import numbered
from framelake.operators.metadata import first_seen
from framelake.shared import made_new

SCHEMA = "task string, task_index long"
#: Seconds that a mark may be there without its content.
PATIENCE = 10.0


@dataclass
class TaskDictionary:
    spark: SparkSession
    path: str

    def _fs(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _mark(self, version: int) -> dict:
        fs, p = self._fs(f"_versions/{version:012d}")
        until = time.monotonic() + PATIENCE
        while True:
            stream = fs.open(p)
            try:
                text = bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
            finally:
                stream.close()
            if text:
                return json.loads(text)
            if time.monotonic() > until:
                raise TimeoutError(f"version {version} of {self.path} has no content")
            time.sleep(0.1)

    def versions(self) -> list[dict]:
        """Marks in order: {table, first, tasks}; a row a run that found new tasks."""
        fs, p = self._fs("_versions")
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        names = sorted(int(n) for n in names if n.isdigit())
        return [self._mark(n) for n in names]

    def tasks(self, version: int | None = None) -> DataFrame:
        """(task, task_index) as of a version (1 is the first), by default the last."""
        found = self.versions()[:version]
        if not found:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/{m['table']}" for m in found])

    def _publish(self, version: int, mark: dict) -> bool:
        """Whether this run's mark is the version's."""
        return made_new(self.spark, f"{self.path}/_versions/{version:012d}", json.dumps(mark))

    def extend(self, rows: DataFrame, task: str, order: list[str]) -> int:
        """Give the rows' unknown tasks the next indices, in order of appearance; the number of new tasks. Null is no task."""
        seen = first_seen(rows, task, order)
        while True:
            known = self.versions()
            base = known[-1]["tasks"] if known else 0
            new = numbered(seen.join(self.tasks(len(known)), "task", "left_anti") if known else seen, ["first", "task"], "task_index")
            name = f"tasks-{uuid.uuid4().hex}"
            new.select("task", (F.col("task_index") + base).alias("task_index")).write.parquet(f"{self.path}/{name}")
            n = self.spark.read.schema(SCHEMA).parquet(f"{self.path}/{name}").count()
            if n and self._publish(len(known) + 1, {"table": name, "first": base, "tasks": base + n}):
                return n
            fs, p = self._fs(name)
            fs.delete(p, True)
            if not n:
                return 0
