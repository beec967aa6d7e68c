"""Connected components of an edge table, with work per round linear in the edges.

Alternating star rounds: every vertex hands its larger neighbours to its smallest one, then
its smaller neighbours likewise, until nothing changes. A hub only ever contributes its
minimum, aggregated before the shuffle; no neighbourhood is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from folioscope.llm.storage import cut


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """``edges`` cut off from their plan, with their number and a sum of hashes, which are taken
    while they are written."""
    seen = Observation()
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    now = cut(edges.observe(seen, F.count(F.lit(1)).alias("n"), digest.alias("digest")))
    return now, (seen.get["n"], seen.get["digest"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` have a > b. Large: link larger neighbours to the minimum; small: the others."""
    around = edges.select("a", "b")
    if large:
        around = around.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    # a round of broadcasts would cost the driver a job and a table for every join
    joined = around.join(least.hint("merge"), "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.union(least.select("a", F.col("m").alias("b")))
    moved = moved.where("a > b")
    # repeated edges do no harm between the two halves of a round
    return moved if large else moved.distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component``: the smallest id reachable, for every id that has an edge to another.

    Null ends and loops are ignored; repeated and reversed edges count once."""
    x, y = F.col(a), F.col(b)
    now, seen = _written(edges.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct())
    while seen[0]:
        last = seen
        now, seen = _written(_star(_star(now, True), False))
        if seen == last:
            break
    stars = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component").alias("id"), "component").distinct())
