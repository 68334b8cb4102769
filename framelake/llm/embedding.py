"""Embedding near-duplicates: PCA-ordered tiled comparison.

Vectors are compared inside a group (label, width). A rotation to principal axes, found from second moments of a bounded
sample, puts most of each vector's length into its first coordinates and keeps every cosine. A group that a tile holds
is one tile. A larger one is cut into strips along the first axis; unit vectors with cosine t or more lie within
sqrt(2 - 2t) of each other, so only equal and neighbouring strips meet. A strip with more rows than a tile holds is cut
into blocks, and each pair of blocks is a tile. A tile streams one side in bands of rows. In a band, products grow a few coordinates at a time; what the rest can add is bounded by the product of the
norms of the vectors' suffixes, and pairs that cannot reach the threshold are given up. What remains is checked in
double precision on the vectors as given.

Equal vectors of a group are taken once, with their number. A tile returns link counts per vector and a spanning set of
its links, so a dense group costs no row a pair. One copy of the vectors is stored, in the type they came in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import group_bounds, key_runs, ready, spanning_links, split_join, stored
from framelake.llm.components import connected_components

#: Rows of a tile: as many as hold TILE_NUMBERS numbers, in these bounds; and rows of one side that meet the other side at once.
TILE_NUMBERS, LEAST_TILE, MOST_TILE = 1 << 22, 1024, 8192
BAND = 256
STEP = 8
SLACK = 1e-9  # above the rounding of a rotated product
#: The sample that axes are fitted on: numbers and rows at most; and the widest vectors that are rotated.
AXES_NUMBERS, AXES_ROWS, WIDEST = 1 << 21, 4096, 2048


def usable(v: str = "v") -> str:
    """SQL: the array has components, none null or non-finite, not all zero."""
    bad = "x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity')"
    return f"size({v}) > 0 AND NOT exists({v}, {bad}) AND exists({v}, x -> x <> 0)"


def _units(piece: pa.RecordBatch | pa.Table, name: str = "v") -> np.ndarray:
    """Rows of one width as unit vectors; scaled by the largest component first, so that no square overflows."""
    column = piece.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_width(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    widths = batch.column("d").to_numpy()
    for d in np.unique(widths):
        yield int(d), batch if (widths == d).all() else batch.filter(pa.array(widths == d))


def principal_axes(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per width d of rows(d, v), a rotation to axes by falling second moment over a sample of AXES_NUMBERS numbers at most.

    The sample is the rows with the smallest hashes. Any rotation keeps every product, so the sample decides on speed
    alone, not on results. Beyond WIDEST numbers a vector's own coordinates, in order of their moments, serve. Widths are
    few by nature.
    """
    found = {}
    for r in rows.groupBy("d").agg(F.count("*").alias("n")).orderBy("d").collect():
        d = r["d"]
        some = rows.where(F.col("d") == d).orderBy(F.xxhash64("v")).limit(max(64, min(AXES_ROWS, AXES_NUMBERS // d))).select("v").toArrow()
        x = _units(some)
        found[d] = np.linalg.eigh(x.T @ x)[1][:, ::-1] if d <= WIDEST else np.argsort(-(x * x).sum(axis=0), kind="stable")
    return found


def rotated(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Rows of x in the coordinates of axes, a matrix of them or an order of x's own."""
    return x @ axes if axes.ndim == 2 else x[:, axes]


def close_pairs(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of unit vectors x, y with cosine >= threshold; px, py are x, y in principal coordinates."""
    d = px.shape[1]
    rest = lambda p: np.sqrt(np.maximum(0, np.cumsum((p * p)[:, ::-1], axis=1)[:, ::-1]))  # noqa: E731  norms of suffixes
    rx, ry = (np.concatenate([rest(p), np.zeros((len(p), 1))], axis=1) for p in (px, py))
    rows, columns, sums = np.arange(len(px)), np.arange(len(py)), np.zeros((len(px), len(py)))
    at = 0
    while at < d:
        to = min(d, at + STEP)
        sums += px[rows, at:to] @ py[columns, at:to].T
        alive = sums + np.outer(rx[rows, to], ry[columns, to]) >= threshold - SLACK
        at = to
        if alive.sum() * 16 < alive.size:  # few are left: pair by pair from here
            a, b = np.nonzero(alive)
            left = sums[a, b]
            a, b = rows[a], columns[b]
            while at < d and len(a):
                to = min(d, at + STEP)
                left = left + np.einsum("ij,ij->i", px[a, at:to], py[b, at:to])
                keep = left + rx[a, to] * ry[b, to] >= threshold - SLACK
                a, b, left, at = a[keep], b[keep], left[keep], to
            break
        some, many = alive.any(axis=1), alive.any(axis=0)
        if not some.all() or not many.all():
            rows, columns, sums = rows[some], columns[many], sums[np.ix_(some, many)]
    else:
        a, b = np.nonzero(sums >= threshold - SLACK)
        a, b = rows[a], columns[b]
    found = []
    for k in range(0, len(a), 1 << 16):
        found.append(np.einsum("ij,ij->i", x[a[k : k + (1 << 16)]], y[b[k : k + (1 << 16)]]) >= threshold)
    keep = np.concatenate(found) if found else np.zeros(0, bool)
    return a[keep], b[keep]


def tile_links(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, own: bool, nx: np.ndarray, ny: np.ndarray, threshold: float):
    """(links of each x, of each y, ends u, v of a spanning forest over x and, behind them, y); own: y is x, pairs count once."""
    links_x, links_y, at = np.zeros(len(x)), np.zeros(len(y)), 0 if own else len(x)
    u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for k in range(0, len(x), BAND):
        a, b = close_pairs(x[k : k + BAND], y, px[k : k + BAND], py, threshold)
        a = a + k
        if own:
            a, b = a[a < b], b[a < b]
        links_x += np.bincount(a, ny[b], len(x))
        links_y += np.bincount(b, nx[a], len(y))
        if len(a):
            u, v = spanning_links(at + len(y), np.concatenate([u, a]), np.concatenate([v, at + b]))
    return links_x, links_y, u, v


def _tile(axes, threshold: float):
    keys = ["g", "d", "s", "i", "j"]

    def handle(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        for s, e in zip(*group_bounds(piece, keys), strict=True):
            if e - s < 2:
                continue
            own = piece.slice(s, e - s)
            side, n, ids = own.column("side").to_numpy(), own.column("n").to_numpy(), own.column("rep")
            x = _units(own)
            p = rotated(x, axes.value[x.shape[1]])
            if own.column("i")[0] == own.column("j")[0]:
                order = np.arange(len(x))
                first, second, u, v = tile_links(x, x, p, p, True, n, n, threshold)
                links = first + second
            else:
                left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                if not len(left) or not len(right):
                    continue
                order = np.concatenate([left, right])
                first, second, u, v = tile_links(x[left], x[right], p[left], p[right], False, n[left], n[right], threshold)
                links = np.concatenate([first, second])
            some = np.flatnonzero(links)
            if not len(some):
                continue
            to = np.arange(len(order))
            to[u] = v
            take = lambda at: pa.array(ids.take(pa.array(order[at])).to_pylist(), pa.binary())
            yield pa.RecordBatch.from_arrays([take(some), take(to[some]), pa.array(links[some].astype(np.int64))], ["u", "v", "links"])

    return lambda batches: key_runs(batches, keys, handle)


def near_duplicates(
    df: DataFrame, ident: str = "vec_id", vector: str = "embedding", group: str = "label", threshold: float = 0.98, tile: int | None = None
) -> DataFrame:
    """df -> (ident, n_links, component_id, kept), a row for each row of df.

    Rows link if their groups are equal and not null, their vectors have one width and cosine >= threshold (0 < threshold
    <= 1). Null, empty and zero vectors, and those with null or non-finite components, link with nothing. Rows with equal
    ids count as rows of their own. component_id is the smallest id reachable; a null id is passed over. tile: rows of a
    tile, by the vectors' width unless given.
    """
    spark = df.sparkSession
    ready(spark)
    single = df.schema[vector].dataType.simpleString() == "array<float>"
    kind = "float" if single else "double"
    rows = df.select(F.col(f"`{ident}`").alias("id"), F.col(f"`{vector}`").cast(f"array<{kind}>").alias("v"), F.col(f"`{group}`").alias("g0"))
    rows = rows.withColumn("ok", F.expr(f"coalesce(g0 IS NOT NULL AND {usable()}, false)"))
    # one name for equal vectors of a group: 128 bits of hashes of group and components, -0.0 as 0.0
    rows = rows.withColumn("v", F.expr(f"IF(ok, transform(v, x -> x + {kind}(0)), NULL)"))
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(n), "g0", "v")), 16, "0") for n in (0, 1)]
    rows = rows.withColumn("rep", F.when(F.col("ok"), F.unhex(F.concat(*halves))))
    good = rows.where("ok").select("rep", "id", F.xxhash64("g0").alias("g"), F.size("v").alias("d"), "v")
    rows, _ = stored(rows.select("id", "ok", "rep"), "rows")
    reps = good.groupBy("rep").agg(F.count("*").alias("n"), F.min("id").alias("low"), *[F.first(c).alias(c) for c in ("g", "d", "v")])
    reps, _ = stored(reps, "reps")
    axes = spark.sparkContext.broadcast(principal_axes(reps))  # d x d numbers for each width
    holds = F.lit(tile) if tile else F.expr(f"greatest({LEAST_TILE}, least({MOST_TILE}, {TILE_NUMBERS} div d))")
    groups, _ = stored(reps.groupBy("g", "d").agg(F.count("*").alias("rows")).select("g", "d", "rows", F.col("rows").alias("members"), holds.cast("int").alias("holds")), "groups")
    total = groups.agg(F.sum("rows")).head()[0] or 0
    width = (2 - 2 * threshold) ** 0.5 + 1e-6

    def strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, own in _by_width(batch):
                s = np.floor(rotated(_units(own), axes.value[d][..., :1])[:, 0] / width).astype(np.int32)
                s[own.column("members").to_numpy() <= own.column("holds").to_numpy()] = 0
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(s)], [*own.schema.names, "s"])

    def cut() -> DataFrame:
        sized = split_join(reps.select("rep", "n", "g", "d", "v"), groups, ["g", "d"], "rows", total).select("rep", "n", "g", "d", "v", "members", "holds")
        return sized.mapInArrow(strips, f"rep binary, n long, g long, d int, v array<{kind}>, members long, holds int, s int")

    sizes = cut().groupBy("g", "d", "s").agg(F.count("*").alias("rows"), F.first("holds").alias("holds"))
    sizes, _ = stored(sizes.select("g", "d", "s", "rows", F.ceil(F.col("rows") / F.col("holds")).cast("int").alias("m")), "sizes")
    above = sizes.select("g", "d", (F.col("s") - 1).alias("s"), F.col("m").alias("up"))
    below = sizes.select("g", "d", (F.col("s") + 1).alias("s"), F.col("m").alias("down"))
    at = ["g", "d", "s"]
    around, _ = stored(sizes.join(above, at, "left").join(below, at, "left"), "around")
    dealt = split_join(cut().drop("members", "holds"), around, at, "rows", total).withColumn("x", F.pmod(F.xxhash64("rep"), F.col("m")).cast("int"))
    # tiles of a strip with itself, and of a strip (side 0) with the next one (side 1)
    own = F.expr("transform(sequence(0, m - 1), y -> struct(s AS s, true AS same, least(x, y) AS i, greatest(x, y) AS j, int(x > y) AS side))")
    up = F.expr("IF(up IS NULL, array(), transform(sequence(0, up - 1), y -> struct(s AS s, false AS same, x AS i, y AS j, 0 AS side)))")
    down = F.expr("IF(down IS NULL, array(), transform(sequence(0, down - 1), y -> struct(s - 1 AS s, false AS same, y AS i, x AS j, 1 AS side)))")
    spot = "array<struct<s:int,same:boolean,i:int,j:int,side:int>>"
    dealt = dealt.select("rep", "n", "g", "d", "v", F.inline(F.concat(own.cast(spot), up.cast(spot), down.cast(spot))))
    keys = ["g", "d", "s", "i", "j"]
    dealt = dealt.withColumn("j", F.expr("IF(same, j, -1 - j)"))  # no tile of neighbours shares a key with one of a strip itself
    tiles = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_tile(axes, threshold), "u binary, v binary, links long")
    tiles, _ = stored(tiles, "tiles")
    counts = tiles.groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
    linked, _ = stored(connected_components(tiles.select("u", "v")).withColumnRenamed("node", "rep"), "linked")
    roots = linked.join(reps.select("rep", "low"), "rep").groupBy("root").agg(F.min("low").alias("least"), F.count("*").alias("members"))
    roots, _ = stored(roots, "roots")
    named = split_join(linked, roots, ["root"], "members", linked.count()).select("rep", "least")
    classes = reps.select("rep", "n", "low").join(named, "rep", "left").join(counts, "rep", "left")
    classes = classes.select("rep", "n", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("least", "low").alias("component_id"))
    classes, _ = stored(classes, "classes")
    found = split_join(rows.where("ok").select("id", "rep"), classes, ["rep"], "n", rows.count()).select("id", "n_links", "component_id")
    rest = rows.where("NOT ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    found = found.union(rest)
    return found.select(F.col("id").alias(ident), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
