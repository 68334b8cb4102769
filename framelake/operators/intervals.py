"""Interval join: points with the intervals that hold them, by nodes of a tree over time.

Time is cut into cells, cells into groups of eight, these into groups of eight again, and so on. An interval is the union
of a few such nodes on each level, and of a point's ancestors, one a level, exactly one is among them. So points and
intervals meet in an equi-join on (key, level, node), which yields a row for each hit and none else, but for points in
an interval's first and last cell that lie just outside of it, which a comparison drops. Overlapping intervals, many of
them, short and long, cost what they hit. Levels end below the whole range's 64th part, so that one key's points aren't
gathered in one node; longer intervals have more nodes.

The nodes are sent to every task if they are few; points aren't moved then. Otherwise both are shuffled by node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 8
#: Parts that the whole range has on the highest level, at least, and cells that an interval of common length is cut into.
TOP_PARTS, CELLS = 64, 8
MOST_LEVELS = 16
BROADCAST_NODES = 200_000


def grid(intervals: DataFrame, start: str = "start", end: str = "end") -> tuple[int, int]:
    """(width of a cell, levels), from the lengths and the range of the intervals."""
    length = F.col(end) - F.col(start)
    r = intervals.where(length > 0).agg(F.percentile_approx(length, 0.05, 1000).alias("short"), (F.max(end) - F.min(start)).alias("range")).head()
    if r["short"] is None:
        return 1, 1
    width, levels = max(1, r["short"] // CELLS), 1
    while levels < MOST_LEVELS and width * FAN**levels * TOP_PARTS <= r["range"]:
        levels += 1
    return width, levels


def nodes(intervals: DataFrame, width: int, levels: int, start: str = "start", end: str = "end") -> DataFrame:
    """A row for each node of each interval [start, end), as __level and __node; none for an empty one."""
    # cells are those that hold start and end; on higher levels, nodes lie between them
    down = lambda x, by: f"(({x}) - pmod({x}, {by}L)) div {by}L"
    first = [down(f"`{start}`", width)] + [f"-({down(f'-`{start}`', width * FAN**k)})" for k in range(1, levels)]
    last = [f"-({down(f'-`{end}`', width)})"] + [down(f"`{end}`", width * FAN**k) for k in range(1, levels)]
    run = lambda k, a, b: f"IF({a} < {b}, transform(sequence({a}, {b} - 1), n -> struct({k} AS __level, n AS __node)), array())"
    kind = "array<struct<__level:int,__node:bigint>>"
    parts = []
    for k in range(levels):
        a, b = f"__a{k}", f"__b{k}"
        if k + 1 == levels:
            parts.append(f"CAST({run(k, a, b)} AS {kind})")
        else:
            left, right = f"__a{k + 1} * {FAN}", f"__b{k + 1} * {FAN}"
            both = f"concat({run(k, a, left)}, {run(k, right, b)})"
            parts.append(f"CAST(IF(__a{k + 1} < __b{k + 1}, {both}, {run(k, a, b)}) AS {kind})")
    edges = {f"__a{k}": F.expr(x) for k, x in enumerate(first)} | {f"__b{k}": F.expr(x) for k, x in enumerate(last)}
    own = [F.col(f"`{c}`") for c in intervals.columns]
    return intervals.where(F.col(f"`{start}`") < F.col(f"`{end}`")).withColumns(edges).select(*own, F.inline(F.expr(f"concat({', '.join(parts)})")))


def interval_join(points: DataFrame, intervals: DataFrame, at: str, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """points ⋈ intervals(by, start, end, ...) with start <= at < end and equal `by`: a row for each point in an interval.

    at, start and end are longs; null ones, null keys and intervals that end before they begin match nothing. A point in
    several intervals gives a row for each. Other columns of the two have different names.
    """
    width, levels = grid(intervals, start, end)
    cut = nodes(intervals, width, levels, start, end)
    few = cut.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    # a point's cell, rounded down, and its ancestors
    cell = F.expr(f"(`{at}` - pmod(`{at}`, {width}L)) div {width}L")
    ladder = F.array(*[F.struct(F.lit(k).alias("__level"), F.expr(f"(__cell - pmod(__cell, {FAN**k}L)) div {FAN**k}L").alias("__node")) for k in range(levels)])
    climbed = points.withColumn("__cell", cell).select(*[F.col(f"`{c}`") for c in points.columns], F.inline(ladder))
    met = climbed.join(F.broadcast(cut) if few else cut.hint("merge"), [*by, "__level", "__node"])
    inside = (F.col(f"`{at}`") >= F.col(f"`{start}`")) & (F.col(f"`{at}`") < F.col(f"`{end}`"))
    return met.where(inside).drop("__level", "__node")
