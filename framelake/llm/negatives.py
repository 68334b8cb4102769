"""Hard-negative mining: rotated partial products, bounded remainders, integer verification.

Vectors are laid on an integer grid, x = floor(scale * c); a score is the integer product of two rows. A rotation to
principal axes, fitted on a bounded sample, keeps every product and puts most of it into few coordinates. Products are
accumulated a few leading coordinates at a time; what the others can add is bounded by the product of the rows' residual
norms plus slack for rounding. A pair goes when it can no longer enter its anchor's lists: when it stays below the least
score that the lists still take, or above the highest that they may take. What is left is scored with integers.

Two searches, each in tiles of a block of anchors with a block of rows: of the same label, the best rows are positives; of
other labels, those scores count that lie between two shares of a positive's. A task holds its anchors and streams the
rows. Anchors are dealt in rounds of a few blocks, so that rows are copied a bounded number of times at once, whatever
the number of anchors. A tile returns an anchor's best few rows; tiles of an anchor are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelake.llm.common import ready, split_join, stored
from framelake.llm.embedding import principal_axes, rotated

SCALE, EVERY, POSITIVES, NEGATIVES, LOW, HIGH = 256, 50, 5, 3, 50, 95
#: Numbers of a block of anchors; rows of a block of rows, in these bounds; blocks of anchors that a round takes.
ANCHOR_NUMBERS, LEAST_ROWS, MOST_ROWS, COPIES = 1 << 21, 2048, 1 << 17, 8
#: Anchors and rows that are compared at once; a block's first rows go in smaller bands, to fill the lists.
SIDE, BANDS = 512, (64, 256, 1024, 4096)
STEP = 8
#: Scores stay below this, so that a hundred times a score is a long too.
LARGEST_SCORE = 2.0**55


def usable(vector: str, scale: int) -> str:
    """SQL: the array has components, none null or non-finite, none so large that a product of two rows might be no long."""
    most = f"sqrt({LARGEST_SCORE:.0f}D / size({vector}))"
    return f"coalesce(size({vector}) > 0 AND NOT exists({vector}, c -> c IS NULL OR isnan(c) OR abs(c) * {scale}D + 1 > {most}), false)"


class Lists:
    """For each slot (anchor, band), the best `most` rows seen with lo <= score <= hi."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray, most: int):
        self.lo, self.hi, self.most = lo, hi, most
        self.last = np.full(lo.size, np.iinfo(np.int64).min)  # the score of a full list's last row
        self.rows = tuple(np.zeros(0, np.int64) for _ in range(4))  # slot, score, id, row

    def least(self) -> np.ndarray:
        """Per anchor, the least score that may still enter one of its lists."""
        return np.maximum(self.lo, self.last.reshape(self.lo.shape)).min(axis=1)

    def most_of_all(self) -> np.ndarray:
        return self.hi.max(axis=1)

    def add(self, anchor: np.ndarray, score: np.ndarray, ident: np.ndarray, row: np.ndarray) -> None:
        bands, new = self.lo.shape[1], []
        for p in range(bands):
            slot = anchor * bands + p
            fits = np.flatnonzero((score >= self.lo[anchor, p]) & (score <= self.hi[anchor, p]) & (score >= self.last[slot]))
            new.append((slot[fits], score[fits], ident[fits], row[fits]))
        slot, score, ident, row = (np.concatenate([old, *more]) for old, *more in zip(self.rows, *new, strict=True))
        order = np.lexsort((row, ident, -score, slot))
        slot = slot[order]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else np.zeros(0, np.int64)
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
        order, slot, place = (x[place < self.most] for x in (order, slot, place))
        self.rows = slot, score[order], ident[order], row[order]
        full = place == self.most - 1
        self.last[slot[full]] = self.rows[1][full]


def residuals(p: np.ndarray, steps: list[int]) -> np.ndarray:
    """Norms of each row's coordinates from each of steps on."""
    squares = np.cumsum((p * p)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.c_[squares, np.zeros(len(p))][:, steps])


def survivors(
    a: np.ndarray, b: np.ndarray, pa_: np.ndarray, pb: np.ndarray, ra: np.ndarray, rb: np.ndarray, least: np.ndarray, most: np.ndarray, wanted: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the wanted pairs of integer rows a, b with least <= score <= most, bounds by anchor.

    pa_, pb are the rows in principal coordinates, ra, rb their residual norms at each step.
    """
    d = a.shape[1]
    steps = list(range(STEP, d, STEP)) + [d]
    least, most = least.astype(np.float64), most.astype(np.float64)
    whole = lambda x: np.sqrt((x * x).sum(axis=1))
    slack = (d + 4) * 2.0**-46  # of the product of two rows' norms: far above what rounding of rotation and sums adds up to
    na, nb = whole(pa_) * slack, whole(pb)
    sums, alive, at = np.zeros((len(a), len(b))), wanted, 0
    x = y = None
    for k, to in enumerate(steps):
        if x is None:
            sums += pa_[:, at:to] @ pb[:, at:to].T
            rest = np.outer(ra[:, k], rb[:, k]) + np.outer(na, nb) + 1e-6
            alive = alive & (sums + rest >= least[:, None]) & (sums - rest <= most[:, None])
            if alive.sum() * 16 < alive.size:  # few are left: pair by pair from here
                x, y = np.nonzero(alive)
                left = sums[x, y]
        elif len(x):
            left = left + np.einsum("ij,ij->i", pa_[x, at:to], pb[y, at:to])
            rest = ra[x, k] * rb[y, k] + na[x] * nb[y] + 1e-6
            keep = (left + rest >= least[x]) & (left - rest <= most[x])
            x, y, left = x[keep], y[keep], left[keep]
        at = to
    if x is None:
        x, y = np.nonzero(alive)
    cuts = range(0, len(x), 1 << 16)
    score = np.concatenate([np.einsum("ij,ij->i", a[x[c : c + (1 << 16)]], b[y[c : c + (1 << 16)]]) for c in cuts]) if len(x) else np.zeros(0, np.int64)
    return x, y, score


class Tile:
    """A block of anchors that rows are streamed past."""

    def __init__(self, anchors: pa.Table, axes: dict, same: bool, most: int):
        anchors = anchors.combine_chunks()
        width = anchors.column("d")[0].as_py()
        self.same, self.axes = same, axes.get(width, np.arange(width))  # none are fitted on zeros
        self.key = {k: anchors.column(k).to_numpy() for k in ("r", "id", "g")}
        self.x = self._matrix(anchors)
        self.p = rotated(self.x.astype(np.float64), self.axes)
        self.steps = list(range(STEP, self.x.shape[1], STEP)) + [self.x.shape[1]]
        self.rest = residuals(self.p, self.steps)
        lo, hi = (anchors.column(c).combine_chunks() for c in ("lo", "hi"))
        widths = np.diff(lo.offsets.to_numpy())
        bands = int(widths.max())
        self.bands = bands
        # a list that an anchor doesn't have takes no score
        low, high = (np.full((len(widths), bands), v, np.int64) for v in (1 << 62, -(1 << 62)))
        has = np.arange(bands) < widths[:, None]
        low[has], high[has] = lo.flatten().to_numpy(), hi.flatten().to_numpy()
        self.lists = [Lists(low[k : k + SIDE], high[k : k + SIDE], most) for k in range(0, len(widths), SIDE)]
        self.seen = 0

    @staticmethod
    def _matrix(rows: pa.Table) -> np.ndarray:
        x = rows.column("x").combine_chunks()
        return x.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(x), -1)

    def add(self, rows: pa.Table) -> None:
        y, r, ident, g = self._matrix(rows), *(rows.column(k).to_numpy() for k in ("r", "id", "g"))
        p = rotated(y.astype(np.float64), self.axes)
        rest, at = residuals(p, self.steps), 0
        while at < len(y):
            to = at + next((b for b in BANDS if self.seen < b), BANDS[-1])
            band = slice(at, min(to, len(y)))
            for k, lists in enumerate(self.lists):
                own = slice(k * SIDE, (k + 1) * SIDE)
                wanted = (self.key["g"][own, None] == g[band]) == self.same
                if self.same:
                    wanted &= self.key["id"][own, None] != ident[band]
                a, b, score = survivors(self.x[own], y[band], self.p[own], p[band], self.rest[own], rest[band], lists.least(), lists.most_of_all(), wanted)
                if len(a):
                    lists.add(a, score, ident[band][b], r[band][b])
            self.seen += band.stop - at
            at = band.stop

    def found(self) -> Iterator[pa.RecordBatch]:
        for k, lists in enumerate(self.lists):
            slot, score, ident, row = lists.rows
            if len(slot):
                anchor = self.key["r"][k * SIDE + slot // self.bands]
                columns = [anchor, (slot % self.bands).astype(np.int32), score, ident, row]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "band", "score", "id", "r"])


FOUND = "a long, band int, score long, id long, r long"
KEYS = ["d", "block", "i", "j"]


def _tiles(axes, same: bool, most: int):
    """Rows sorted by tile, a tile's anchors first -> the best rows of each of its lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tile, anchors = None, None, []
        for batch in batches:
            keys = [batch.column(k).to_numpy() for k in (*KEYS, "side")]
            change = np.zeros(batch.num_rows, bool)
            change[:1] = True
            for k in keys:
                change[1:] |= k[1:] != k[:-1]
            starts = np.flatnonzero(change)
            for s, e in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                key, part = tuple(k[s] for k in keys[:-1]), pa.Table.from_batches([batch.slice(s, e - s)])
                if key != now:
                    if tile:
                        yield from tile.found()
                    now, tile, anchors = key, None, []
                if keys[-1][s] == 0:
                    anchors.append(part)
                elif anchors or tile:
                    tile = tile or Tile(pa.concat_tables(anchors), axes.value, same, most)
                    anchors = []
                    tile.add(part)
        if tile:
            yield from tile.found()

    return run


def search(rows: DataFrame, anchors: DataFrame, axes, same: bool, most: int) -> DataFrame:
    """(a, band, score, id, r): per anchor and band, the best `most` rows, ranked again over all tiles.

    rows(r, id, g, d, x) and anchors(r, id, g, d, x, lo, hi), a band of scores for each entry of lo and hi. same: rows of
    the anchor's g and of another id; else rows of any other g.
    """
    spark = rows.sparkSession
    block = F.col("g") if same else F.lit(0).cast("long")
    rows, anchors = rows.withColumn("block", block), anchors.withColumn("block", block)
    of = ["d", "block"]
    n = rows.groupBy(*of).agg(F.count("*").alias("n"))
    sizes = anchors.groupBy(*of).agg(F.count("*").alias("m")).join(n, of)
    blocks = F.ceil(F.col("m") / F.greatest(F.lit(1), F.expr(f"{ANCHOR_NUMBERS} div d"))).cast("int")
    deal = F.ceil(F.col("n") / F.least(F.greatest(F.ceil(F.col("n") / 32), F.lit(LEAST_ROWS)), F.lit(MOST_ROWS))).cast("int")
    sizes, _ = stored(sizes.select(*of, "n", blocks.alias("ai"), deal.alias("rj")), "sizes")
    total = sizes.agg(F.sum("n"), F.max("ai"), F.max("rj"), F.sum(F.col("ai").cast("long") * F.col("rj"))).head()
    if not total[0]:
        return spark.createDataFrame([], f"{FOUND}, rank int")
    rows = split_join(rows, sizes, of, "n", total[0]).withColumn("j", F.pmod(F.xxhash64("r"), F.col("rj")).cast("int"))
    anchors = split_join(anchors, sizes, of, "n", total[0]).withColumn("i", F.pmod(F.xxhash64("r", F.lit(1)), F.col("ai")).cast("int"))
    kept = [*KEYS, "side", "r", "id", "g", "x", "lo", "hi"]
    none = F.lit(None).cast("array<bigint>")
    parts = []
    for first in range(0, total[1], COPIES):
        held = anchors.where((F.col("i") >= first) & (F.col("i") < first + COPIES)).withColumn("side", F.lit(0))
        held = held.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("rj") - 1))).select(*kept)
        past = rows.where(F.col("ai") > first).withColumn("i", F.explode(F.sequence(F.lit(first), F.least(F.col("ai"), F.lit(first + COPIES)) - 1)))
        past = past.withColumns({"side": F.lit(1), "lo": none, "hi": none}).select(*kept)
        tasks = int(min(20_000, 2 * total[3]))
        dealt = held.unionByName(past).repartition(tasks, *KEYS).sortWithinPartitions(*KEYS, "side")
        parts.append(stored(dealt.mapInArrow(_tiles(axes, same, most), FOUND), "found")[0])
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    best = Window.partitionBy("a", "band").orderBy(F.desc("score"), "id", "r")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


def hard_negatives(
    df: DataFrame, ident: str = "vec_id", vector: str = "embedding", label: str = "label", anchor: Column | None = None, scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """df -> (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor is a row for which `anchor` holds, by default one whose integer id is divisible by EVERY. Its positives are
    the first rows of its label with another id, by falling score, ties by smaller id; its negatives for a positive the
    first rows of other labels whose score is from low to high hundredths of the positive's. Fewer are returned where
    there are fewer; an anchor without positives, and a positive without negatives, gives no row.

    Rows with a null id, label or vector, an empty vector, null or non-finite components, or components whose products
    might not fit (beyond sqrt(2^55 / width) / scale) take no part. Rows of different widths don't meet. Rows with equal
    ids are rows of their own, so that an anchor's id may come twice. Columns of other names are left out, whatever they
    are called. An empty table gives an empty result.
    """
    spark = df.sparkSession
    ready(spark)
    if anchor is None:
        anchor = F.col(f"`{ident}`") % EVERY == 0
    rows = df.select(F.col(f"`{ident}`").cast("long").alias("id"), F.col(f"`{label}`").alias("g"), F.col(f"`{vector}`").cast("array<double>").alias("v"), anchor.alias("is_anchor"))
    rows = rows.where(f"id IS NOT NULL AND g IS NOT NULL AND {usable('v', scale)}").withColumn("x", F.transform("v", lambda c: F.floor(c * F.lit(float(scale)))))
    rows = rows.select(F.monotonically_increasing_id().alias("r"), "id", F.xxhash64("g").alias("g"), F.size("x").alias("d"), "x", F.coalesce("is_anchor", F.lit(False)).alias("is_anchor"))
    rows, _ = stored(rows, "rows")
    axes = spark.sparkContext.broadcast(principal_axes(rows.select("d", F.col("x").cast("array<double>").alias("v")).where("exists(v, c -> c <> 0)")))
    every = rows.drop("is_anchor")
    picked = rows.where("is_anchor").drop("is_anchor")
    widest = F.array(F.lit(int(LARGEST_SCORE)))
    near, _ = stored(search(every, picked.withColumns({"lo": F.transform(widest, lambda c: -c), "hi": widest}), axes, True, positives), "positives")
    # negatives' bounds as integers: low p <= 100 n <= high p
    band = F.struct("rank", F.col("score").alias("p"), F.col("id").alias("positive_id"))
    lists = near.groupBy(F.col("a").alias("r")).agg(F.array_sort(F.collect_list(band)).alias("bands"))  # `positives` entries at most
    hundredths = lambda share: f"(b.p * {share}L - pmod(b.p * {share}L, 100L)) div 100L"  # noqa: E731  rounded down
    bounded, _ = stored(picked.join(lists, "r").selectExpr("*", f"transform(bands, b -> -({hundredths(-low)})) AS lo", f"transform(bands, b -> {hundredths(high)}) AS hi"), "bounded")
    far = search(every, bounded.drop("bands"), axes, False, negatives)
    named = bounded.select(F.col("r").alias("a"), F.col("id").alias("anchor_id"), F.posexplode("bands").alias("band", "b"))
    named = named.select("a", "anchor_id", "band", F.col("b.positive_id").alias("positive_id"), F.col("b.p").alias("positive_score"))
    out = far.select("a", "band", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(named, ["a", "band"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
