"""Tables, scratch storage and row streaming shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.shipping import ship

#: Fixed value: what the corpus tables call a word is a run of anything but these ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Bytes of rows that go to a Python worker at once.
BATCH_BYTES = 8 * 1024 * 1024
#: Keys at most that a table is sent for to every task, as too many rows have them; and rows a key has at least then.
HOT_KEYS, LEAST_HOT = 20_000, 100
#: Rows of a few dozen bytes each that a broadcast may have.
BROADCAST_ROWS = 200_000


def ready(spark: SparkSession) -> None:
    """What Python operators need of a session: their code on the executors, and batches that stay small with long texts."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column):
    """A-Z only, so that bytes above 0x7F stay as they are."""
    return F.translate(column, UPPER, LOWER)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; where it is unset, a temporary one, on a local master only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="framelake-")
    spark.conf.set("spark.checkpoint.dir", f"file://{own}")
    return f"file://{own}"


#: Scratch tables of the block that runs in this context.
_MADE: ContextVar[list[str] | None] = ContextVar("framelake_scratch", default=None)


def new_path(spark: SparkSession, kind: str) -> str:
    ready(spark)
    path = f"{scratch_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


def stored(df: DataFrame, kind: str, compression: str | None = None) -> tuple[DataFrame, str]:
    """df written as Parquet to the shared folder and read back: lineage ends there, and a lost executor costs a reread."""
    spark, path = df.sparkSession, new_path(df.sparkSession, kind)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, path: str | None) -> None:
    """Remove a scratch table that nothing reads any more."""
    if path:
        made = _MADE.get()
        if made and path in made:
            made.remove(path)
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def folders_read(df: DataFrame) -> set[str]:
    """Root paths of the file tables that a plan reads; a few, however many files they have."""
    found, leaves = set(), df._jdf.queryExecution().analyzed().collectLeaves()
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and hasattr(leaf.relation(), "location"):
            roots = leaf.relation().location().rootPaths()
            found |= {roots.apply(i).toUri().getPath() for i in range(roots.size())}
    return found


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside go when the block ends."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            dropped(spark, path)


def tidy(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """f(spark, ...) -> DataFrame; of its scratch tables only those stay that the result still has to read."""

    @functools.wraps(f)
    def run(spark: SparkSession, *args, **options) -> DataFrame:
        made: list[str] = []
        before, token = _MADE.get(), _MADE.set(made)
        try:
            out = f(spark, *args, **options)
            needed = folders_read(out)
        except BaseException:
            needed = set()
            raise
        finally:
            _MADE.reset(token)
            for path in made:
                own = spark._jvm.java.net.URI(path).getPath()
                if any(x == own or x.startswith(f"{own}/") for x in needed):
                    if before is not None:
                        before.append(path)
                else:
                    dropped(spark, path)
        return out

    return run


def checked_broadcast(table: DataFrame, n: int) -> DataFrame:
    """A narrow table of n rows, to be joined: sent to every task if n allows, else met in a merge join."""
    return F.broadcast(table) if n <= BROADCAST_ROWS else table.hint("merge")


def split_join(rows: DataFrame, table: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """rows joined with table, which has a row a key and, as n, how many of the `total` rows have it.

    A key with many rows would put them all in one task; there are at most HOT_KEYS such keys, so these are sent to
    every task, and all others meet in a merge join. n is left out of the result.
    """
    limit = max(LEAST_HOT, -(-total // HOT_KEYS))
    hot = F.broadcast(table.where(F.col(n) > limit).drop(n))
    cold = table.where(F.col(n) <= limit).drop(n)
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(cold.hint("merge"), keys))


def key_runs(
    batches: Iterator[pa.RecordBatch], keys: list[str], handle: Callable[[pa.Table], Iterator[pa.RecordBatch]]
) -> Iterator[pa.RecordBatch]:
    """Cut a stream that is sorted by keys (no nulls) into pieces that hold whole groups, and pass each piece on.

    Only the group that a batch ends in is carried over to the next one, so memory follows the largest group.
    """
    carry: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            changed[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(changed)
        first = int(starts[0]) if len(starts) else batch.num_rows
        if carry and any(carry[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            first = 0
        if first == batch.num_rows:
            carry.append(batch)
            continue
        cut = int(starts[-1]) if len(starts) else 0
        done = pa.Table.from_batches([*carry, batch.slice(0, cut)]) if carry or cut else None
        if done is not None and done.num_rows:
            yield from handle(done.combine_chunks())
        carry = [batch.slice(cut)]
    if carry:
        yield from handle(pa.Table.from_batches(carry).combine_chunks())


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what is made of a batch stays small too."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run with its memory given back at the end: a Python worker lives on, beside those of the stages that follow."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return own


def group_bounds(piece: pa.Table, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """First row and row after the last of each group in a sorted table."""
    changed = np.zeros(piece.num_rows, dtype=bool)
    changed[0] = True
    for k in keys:
        v = piece.column(k).to_numpy()
        changed[1:] |= v[1:] != v[:-1]
    starts = np.flatnonzero(changed)
    return starts, np.append(starts[1:], piece.num_rows)


def spanning_links(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of 0..n-1, links from each linked item to the smallest of its group: as connected, at most n - 1."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    linked = np.flatnonzero(label != np.arange(n))
    return linked, label[linked]
