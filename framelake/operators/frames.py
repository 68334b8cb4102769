"""Frames to rows of the output table: projection, fill and pivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed value: width of an action no frame of an episode has.
DEFAULT_ACTION = 14


def project(frames: DataFrame) -> DataFrame:
    """state: the first entry, by key, of states whose key names an observation or a state; action: the first action."""
    keep = lambda k, v: k.contains("observation") | k.contains("state")
    first = lambda m: F.element_at(m, F.get(F.array_sort(F.map_keys(m)), F.lit(0)))
    states = F.map_filter("states", keep)
    state = F.when(F.size(states) > 0, first(states))
    action = F.when(F.size("actions") > 0, first(F.col("actions")))
    return frames.withColumn("state", state).withColumn("action", action).withColumn("timestamp", F.col("timestamp_ns").cast("double") / F.lit(1e9))


def widths(rows: DataFrame, by: list[str], order: str = "frame_index") -> DataFrame:
    """Per episode: state width of the first frame that has a state, action width of the first non-empty action."""
    n = lambda c: F.when(F.size(c) > 0, F.size(c))
    state = F.when(F.col("state").isNotNull(), F.size("state"))
    return rows.groupBy(*by).agg(
        F.min_by(state, F.when(state.isNotNull(), F.col(order))).alias("state_dim"),
        F.coalesce(F.min_by(n("action"), F.when(n("action").isNotNull(), F.col(order))), F.lit(DEFAULT_ACTION)).alias("action_dim"),
    )


def fitted(vector: Column, dim: Column | int) -> Column:
    """Exactly dim values: zeros after a short vector, a long one cut."""
    dim = F.lit(dim) if isinstance(dim, int) else dim
    return F.transform(F.sequence(F.lit(1), dim), lambda i: F.coalesce(F.get(vector, i - 1), F.lit(0.0)).cast("float"))


def forward_filled(rows: DataFrame, by: list[str], order: str = "frame_index", columns: tuple = ("state", "action")) -> DataFrame:
    """Own value, else the last one seen in the episode; null before the first. An empty vector counts as none."""
    upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    for c in columns:
        rows = rows.withColumn(c, F.last(F.when(F.size(c) > 0, F.col(c)), ignorenulls=True).over(upto))
    return rows


def filled(rows: DataFrame, by: list[str], order: str = "frame_index") -> DataFrame:
    """Every frame with state and action: own, last seen, else zeros.

    A state has the width of the episode's first state, an action that of the filled episode's first action that isn't
    empty; before an episode's first action there are as many zeros as a state has, so an episode that begins without
    an action has actions of the state's width.
    Episodes in which no frame has a state are an error; they go to `without_state` instead of being dropped unseen.
    """
    dims = widths(rows, by, order).select(*by, "state_dim").where("state_dim IS NOT NULL")
    out = forward_filled(rows, by, order).join(dims, by)
    out = out.withColumn("action", F.coalesce("action", fitted(F.array().cast("array<float>"), F.col("state_dim"))))
    first = F.first(F.size("action")).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    action_dim = F.when(first > 0, first).otherwise(F.lit(DEFAULT_ACTION))
    out = out.withColumn("action_dim", action_dim)
    return out.withColumn("state", fitted(F.col("state"), F.col("state_dim"))).withColumn("action", fitted(F.col("action"), F.col("action_dim")))


def without_state(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("state").alias("n")).where("n = 0").drop("n")


def stated_only(rows: DataFrame, by: list[str]) -> DataFrame:
    """The stricter writer: frames without a state go, states aren't filled, actions default to at most 14 zeros."""
    kept = rows.where(F.col("state").isNotNull())
    upto = Window.partitionBy(*by).orderBy("frame_index").rowsBetween(Window.unboundedPreceding, 0)
    action = F.last(F.when(F.size("action") > 0, F.col("action")), ignorenulls=True).over(upto)
    zeros = F.transform(F.sequence(F.lit(1), F.least(F.size("state"), F.lit(DEFAULT_ACTION))), lambda _: F.lit(0.0).cast("float"))
    return kept.withColumn("action", F.coalesce(action, zeros))


def pivoted(rows: DataFrame, vectors: dict[str, tuple[str, int]]) -> DataFrame:
    """Vectors to columns: {column: (prefix, width)} gives prefix.0, prefix.1, ...; missing places are 0."""
    keep = [F.col(f"`{c}`") for c in rows.columns if c not in vectors]
    out = [F.coalesce(F.get(F.col(c), F.lit(i)), F.lit(0.0)).cast("float").alias(f"{name}.{i}") for c, (name, dim) in vectors.items() for i in range(dim)]
    return rows.select(*keep, *out)
