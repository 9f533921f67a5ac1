"""Connected components of a link table: stars within blocks of links, then alternating stars across the blocks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.store import stored

#: Links that a task joins in memory at a time (some tens of MB).
BLOCK = 1 << 18


def _block_stars(edges: DataFrame, block: int) -> DataFrame:
    """Links of the same components: within each block of links, every node hangs on the smallest that it reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := above.setdefault(x, x)) != x:
                above[x] = x = above[up]
            return x

        def stars() -> pa.RecordBatch:
            pairs = [(x, r) for x in above if (r := top(x)) != x]
            return pa.RecordBatch.from_pydict(
                {"u": pa.array([x for x, _ in pairs], pa.int64()), "v": pa.array([r for _, r in pairs], pa.int64())}
            )

        held = 0
        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
                a, b = top(u), top(v)
                above[max(a, b)] = min(a, b)
                held += 1
                if held >= block:
                    yield stars()
                    above.clear()
                    held = 0
        if above:
            yield stars()

    return edges.mapInArrow(run, "u long, v long")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each node on its smallest neighbour (or itself)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.filter("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them; `edges` point from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).filter("u <> v").distinct()


def components(edges: DataFrame, block: int = BLOCK) -> DataFrame:
    """(node, root): the smallest node of the component of every node in `edges` (u, v).

    Null ends are not allowed; links of a node with itself and repeated links don't matter, and a node that has only
    links with itself is not returned. Up to `block` links are one block, whose stars are the components; beyond that,
    stars of several blocks meet in rounds over the whole table.
    """
    now = stored(edges.select("u", "v").filter("u <> v").distinct(), "links")
    parts = -(-now.count() // block)
    now = stored(_block_stars(now.repartition(max(1, parts)), block), "stars")
    state = None
    while parts > 1:
        now = stored(_small_star(_large_star(now)), "links")
        new = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == state:
            break
        state = new
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
