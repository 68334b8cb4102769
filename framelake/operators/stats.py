"""Vector statistics: per episode, and merged over episodes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.shipping import ship
from framelake.sorted_groups import begins


#: What a group's moments consist of on their way: rows, first row's place in order and width, and an entry a dimension.
PARTIAL = "feature int, n long, o long, w int, low array<double>, high array<double>, mean array<double>, m2 array<double>"


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of numbers as wide as the widest: (numbers, which are there)."""
    widths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    there = np.arange(int(widths.max(initial=0))) < widths[:, None]
    flat = column.flatten()
    numbers = np.zeros(there.shape)
    numbers[there] = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False)
    there[there] = pc.is_valid(flat).to_numpy(zero_copy_only=False)
    return numbers, there


def _least(low: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Least of each run, infinite where there is none; a NaN is larger than any number, as Spark holds."""
    least = np.fmin.reduceat(low, starts, axis=0)
    return np.where(np.isinf(least) & (least > 0) & np.logical_or.reduceat(np.isnan(low), starts, axis=0), np.nan, least)


def _moments(x: np.ndarray, there: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(min, max, mean, sum of squared deviations) of each run of rows; what isn't there counts as 0 in the last two."""
    n = np.diff(np.r_[starts, len(x)])
    with np.errstate(invalid="ignore", over="ignore"):
        low = np.fmin.reduceat(np.where(there, x, np.inf), starts, axis=0)
        nan = np.add.reduceat((there & np.isnan(x)).astype(np.int64), starts, axis=0)
        low = np.where(nan == np.maximum(1, np.add.reduceat(there.astype(np.int64), starts, axis=0)), np.nan, low)
        high = np.maximum.reduceat(np.where(there, x, -np.inf), starts, axis=0)
        mean = np.add.reduceat(x, starts, axis=0) / n[:, None]
        return low, high, mean, np.add.reduceat((x - np.repeat(mean, n, axis=0)) ** 2, starts, axis=0)


def _firsts(group: np.ndarray, o: pa.Array, w: np.ndarray) -> np.ndarray:
    """The row of each group that comes first by order, nulls first, and then by width; groups are numbered from 0."""
    order = np.lexsort((w, pc.fill_null(o, 0).to_numpy(zero_copy_only=False), pc.is_valid(o).to_numpy(zero_copy_only=False), group))
    return order[np.flatnonzero(np.diff(group[order], prepend=-1))]


def _lists(numbers: np.ndarray, widths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(widths)], pa.int32()), pa.array(numbers))


def _partials(by: list[str], features: int):
    """Batches of (by, o, v0, v1, ...) -> a row for each group and feature of a batch, moments of whole vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.zeros(batch.num_rows, np.int64)
            for k in by:
                own = pc.dictionary_encode(batch.column(k), null_encoding="encode")
                code = np.unique(code * (len(own.dictionary) + 1) + own.indices.to_numpy(), return_inverse=True)[1]
            for f in range(features):
                rows = np.flatnonzero(pc.is_valid(batch.column(f"v{f}")).to_numpy(zero_copy_only=False))
                if not len(rows):
                    continue
                rows = rows[np.argsort(code[rows], kind="stable")]
                vectors, o = batch.column(f"v{f}").take(pa.array(rows)), batch.column("o").take(pa.array(rows))
                x, there = _matrix(vectors)
                w = pc.list_value_length(vectors).to_numpy().astype(np.int64)
                new = np.diff(code[rows], prepend=-1) != 0
                starts, group = np.flatnonzero(new), np.cumsum(new) - 1
                first, widths = _firsts(group, o, w), np.maximum.reduceat(w, starts)
                held = np.arange(x.shape[1]) < widths[:, None]
                columns = [batch.column(k).take(pa.array(rows[starts])) for k in by]
                columns += [pa.array(np.full(len(starts), f, np.int32)), pa.array(np.diff(np.r_[starts, len(rows)])), o.take(pa.array(first)), pa.array(w[first], pa.int32())]
                columns += [_lists(v[held], widths) for v in _moments(x, there, starts)]
                yield pa.RecordBatch.from_arrays(columns, [*by, "feature", "n", "o", "w", "low", "high", "mean", "m2"])

    return run


def _merged(batch: pa.RecordBatch, keys: list[str]) -> pa.RecordBatch:
    """Partial rows, sorted by group, as one for each group; a narrower one counts as zeros beyond its width.

    Deviations are taken from the means of partial rows, not from sums of squares.
    """
    new = begins(batch, keys)
    starts, group = np.flatnonzero(new), np.cumsum(new) - 1
    if len(starts) == batch.num_rows:
        return batch
    n, widths = batch.column("n").to_numpy(), pc.list_value_length(batch.column("mean")).to_numpy().astype(np.int64)
    first, total, wide = _firsts(group, batch.column("o"), batch.column("w").to_numpy()), np.add.reduceat(n, starts), np.maximum.reduceat(widths, starts)
    row = np.repeat(np.arange(batch.num_rows), widths)
    dim = np.arange(len(row)) - np.repeat(np.cumsum(widths) - widths, widths)
    order = np.lexsort((dim, group[row]))
    row, dim = row[order], dim[order]
    low, high, mean, m2 = (batch.column(c).flatten().to_numpy(zero_copy_only=False)[order] for c in ("low", "high", "mean", "m2"))
    cells = np.flatnonzero((np.diff(dim, prepend=-1) != 0) | (np.diff(group[row], prepend=-1) != 0))
    if len(cells):
        here, all_ = n[row], total[group[row[cells]]]
        with np.errstate(invalid="ignore", over="ignore"):
            whole = np.add.reduceat(here * mean, cells) / all_
            gap = mean - np.repeat(whole, np.diff(np.r_[cells, len(row)]))
            m2 = np.add.reduceat(m2 + here * gap * gap, cells)
            short = all_ - np.add.reduceat(here, cells)
            m2 = np.where(short > 0, m2 + short * whole * whole, m2)
            low, high, mean = _least(low, cells), np.maximum.reduceat(high, cells), whole
    columns = [batch.column(k).take(pa.array(starts)) for k in keys] + [pa.array(total), *[batch.column(c).take(pa.array(first)) for c in ("o", "w")]]
    return pa.RecordBatch.from_arrays(columns + [_lists(v, wide) for v in (low, high, mean, m2)], batch.schema.names)


def _finished(by: list[str], names: list[str]):
    """Partial rows sorted by group and feature -> a row a dimension, up to the first row's width."""

    def rows(own: pa.RecordBatch) -> pa.RecordBatch:
        w, widths = own.column("w").to_numpy().astype(np.int64), pc.list_value_length(own.column("mean")).to_numpy().astype(np.int64)
        group = np.repeat(np.arange(own.num_rows), widths)
        dim = np.arange(len(group)) - np.repeat(np.cumsum(widths) - widths, widths)
        kept = dim < w[group]
        group, dim = group[kept], dim[kept]
        low, high, mean, m2 = (own.column(c).flatten().to_numpy(zero_copy_only=False)[kept] for c in ("low", "high", "mean", "m2"))
        n, empty = own.column("n").to_numpy()[group], (low == np.inf) & (high == -np.inf)
        columns = [own.column(k).take(pa.array(group)) for k in by]
        columns += [pa.array(dim.astype(np.int32)), pa.array(n), pa.array(low, mask=empty), pa.array(high, mask=empty), pa.array(mean), pa.array(np.sqrt(np.maximum(0.0, m2 / n)))]
        columns.append(pa.array(names).take(own.column("feature").take(pa.array(group))))
        return pa.RecordBatch.from_arrays(columns, [*by, "dim", "n_rows", "min", "max", "mean", "std", "feature"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch.cast(held.schema)]).combine_chunks().to_batches()[0]
            own = _merged(batch, [*by, "feature"])
            held = own.slice(own.num_rows - 1)  # its group may go on
            if own.num_rows > 1:
                yield rows(own.slice(0, own.num_rows - 1))
        if held is not None:
            yield rows(held)

    return run


def episode_stats(rows: DataFrame, by: list[str], vectors: dict[str, str], order: str = "frame_index") -> DataFrame:
    """(by, dim, n_rows, min, max, mean, std, feature) of each {feature: column}, over values as recorded: call before any fill.

    One scan for all features. Each batch of rows gives the moments of whole vectors for its groups; these, a few arrays a
    group, are shuffled, sorted and merged pairwise, so numbers far from zero keep their deviations. The width is that of
    the first row by `order`, a number. mean divides by all rows, so a short row counts in n and adds nothing; std is the
    population's. Null vectors are no rows; null numbers are none, and a dimension of nothing else has no least or largest.
    """
    spark = rows.sparkSession
    ship(spark)
    own = rows.select(*by, F.col(order).cast("long").alias("o"), *[F.col(c).cast("array<double>").alias(f"v{k}") for k, c in enumerate(vectors.values())])
    kinds = ", ".join(f"`{c}` {own.schema[c].dataType.simpleString()}" for c in by)
    head = f"{kinds}, " if by else ""
    parts = own.mapInArrow(_partials(by, len(vectors)), f"{head}{PARTIAL}")
    dealt = parts.repartition(*by, "feature").sortWithinPartitions(*by, "feature")
    return dealt.mapInArrow(_finished(by, list(vectors)), f"{head}dim int, n_rows long, min double, max double, mean double, std double, feature string")


def vector_stats(rows: DataFrame, by: list[str], vector: str, order: str) -> DataFrame:
    """(by, dim, n_rows, min, max, mean, std) of one vector column, as episode_stats."""
    return episode_stats(rows, by, {vector: vector}, order).drop("feature")


def merged(stats: DataFrame, by: list[str], exact: bool = False) -> DataFrame:
    """Episode statistics (n_rows, min, max, mean, std) to those of their union, per `by`.

    With exact, std is taken as the population's and the result's is too. Without, std is taken and given as a sample's
    (squared deviations are std^2 (n - 1)), which is how published data sets have been merged; one row gives 0.
    Only sums are exchanged, so partial results combine on both sides of the shuffle.
    """
    free = 0 if exact else 1
    n, m, s = F.col("n_rows"), F.col("mean"), F.col("std")
    sums = stats.groupBy(*by).agg(
        F.sum(n).alias("N"), F.min("min").alias("min"), F.max("max").alias("max"), F.sum(n * m).alias("__nm"), F.sum(n * m * m).alias("__nmm"), F.sum(s * s * (n - free)).alias("__m2")
    )
    mean = F.col("__nm") / F.col("N")
    m2 = F.col("__m2") + F.greatest(F.lit(0.0), F.col("__nmm") - F.col("N") * mean * mean)
    std = F.when(F.col("N") > free, F.sqrt(m2 / F.nullif(F.col("N") - free, F.lit(0)))).otherwise(F.lit(0.0))
    return sums.select(*by, F.col("N").alias("n_rows"), "min", "max", mean.alias("mean"), std.alias("std"))


def consistent(stats: DataFrame) -> DataFrame:
    """Features whose episodes agree on their width, (feature, width); others can't be merged."""
    dims = stats.groupBy("episode_index", "feature").agg((F.max("dim") + 1).alias("width"))
    return dims.groupBy("feature").agg(F.min("width").alias("width"), F.max("width").alias("__most")).where("width = __most").drop("__most")


def totals(episodes: DataFrame, frames: str = "length") -> DataFrame:
    """Each episode once."""
    return episodes.dropDuplicates(["episode_index"]).agg(F.count("*").alias("total_episodes"), F.coalesce(F.sum(frames), F.lit(0)).alias("total_frames"))


def writer_totals(parts: DataFrame) -> DataFrame:
    """Sums over writers that ran side by side: they last as long as the longest."""
    out = parts.agg(F.sum("frames").alias("frames"), F.sum("bytes").alias("bytes"), F.max("seconds").alias("seconds"))
    return out.withColumns({"fps": rate("frames", "seconds"), "mb_per_sec": rate(F.col("bytes") / 1048576, "seconds")})


def share(part: Column, rest: Column) -> Column:
    """part of part and rest, 0 of nothing: names found again among all, or hits of a cache."""
    whole = part + rest
    return F.when(whole > 0, part / F.nullif(whole, F.lit(0))).otherwise(F.lit(0.0))


def average(amount: Column, n: Column) -> Column:
    """amount by n; 0 for none."""
    return F.when(n > 0, amount / F.nullif(n, F.lit(0))).otherwise(F.lit(0.0))


def rate(amount, seconds):
    """amount a second; 0 for no time."""
    amount, seconds = (F.col(x) if isinstance(x, str) else x for x in (amount, seconds))
    return F.when(seconds > 0, amount / F.nullif(seconds, F.lit(0))).otherwise(F.lit(0.0))
