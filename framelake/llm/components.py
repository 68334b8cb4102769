"""Connected components of a link table by alternating large-star and small-star steps.

Both steps are joins and minimum aggregates. No vertex's neighbours are gathered in one row. The minimum of a vertex with
many neighbours, the centre of a star above all, is sent to every task, where its rows are; there are few such
vertices, as together they have twice the links at most. Every round is written to the shared folder, so that lineage
stays short and a lost executor costs at most a round. A table of few links is settled in one task: the plans of all
rounds would take the driver more memory than the links take.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import dropped, spanning_links, split_join, stored

#: Links that one task may hold.
FEW_LINKS = 50_000


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    # larger neighbours only: of an edge, the row that begins at its lower end
    near = split_join(edges.select(F.col("v").alias("u"), F.col("u").alias("v")), low, ["u"], "n", 2 * n)
    return near.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    near = split_join(edges, low, ["u"], "n", n).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(low.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
    return tuple(row)


def _at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All links -> (node, root)."""
    links = pa.Table.from_batches(list(batches))
    u, v = (links.column(c).combine_chunks() for c in ("u", "v"))
    nodes = pc.unique(pa.concat_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (u, v)]))
    nodes = nodes.take(pc.sort_indices(nodes))
    low = np.arange(len(nodes))
    a, b = spanning_links(len(nodes), *(pc.index_in(x, nodes).to_numpy(zero_copy_only=False).astype(np.int64) for x in (u, v)))
    low[a] = b
    yield pa.RecordBatch.from_arrays([nodes, nodes.take(pa.array(low))], ["node", "root"])


def connected_components(links: DataFrame, rounds: int = 60, few: int = FEW_LINKS) -> DataFrame:
    """links(u, v) of one comparable type -> (node, root): every linked node, its root the smallest node it reaches.

    Up to `few` links are settled in one task. Null ends and loops are ignored; repeated links count once. An empty table gives an empty result.
    """
    spark = links.sparkSession
    clean = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, path = stored(clean, "links")
    seen = _mark(edges)
    if 0 < seen[0] <= few:
        kind = edges.schema["u"].dataType.simpleString()
        found, _ = stored(edges.coalesce(1).mapInArrow(_at_once, f"node {kind}, root {kind}"), "components")
        dropped(spark, path)
        return found
    for _ in range(rounds):
        if not seen[0]:
            break
        # a job a star: plans of both at once would have the driver plan each of their many exchanges over again
        large, large_path = stored(_large_star(edges, seen[0]), "links")
        new, new_path = stored(_small_star(large, seen[0]), "links")
        now = _mark(new)
        dropped(spark, path)
        dropped(spark, large_path)
        edges, path = new, new_path
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    star = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return star.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
