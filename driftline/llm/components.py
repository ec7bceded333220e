"""Connected components of a large graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm import base
from driftline.llm.base import discard, materialise, maybe_broadcast


#: Edges for each task, about: a counted graph is worked on in as many tasks as that makes, if these are fewer than the session's.
EDGES_A_TASK = 50_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _spread(df: DataFrame, edges: int) -> DataFrame:
    tasks = max(1, -(-edges // EDGES_A_TASK))
    return df.coalesce(tasks) if tasks < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def minima(edges: DataFrame, most: int) -> DataFrame:
    """(u, m): each node's least neighbour, of ``most`` rows at most.

    Broadcast where that bound allows. Else written, so that adaptive execution can split a node with very many neighbours
    when they are joined.
    """
    least = _spread(edges.groupBy("u").agg(F.min("v").alias("m")), most)
    if most <= base.BROADCAST_ROWS:
        return F.broadcast(least)
    least = materialise(least, "least")
    return maybe_broadcast(least, least.count())


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges (u, v), any comparable type, neither null -> (node, root): each node of an edge and the smallest node it reaches.

    Large-star: each node sends its larger neighbours to its smallest one. Small-star: each node sends its smaller neighbours
    and itself to the smallest. Repeated until the edges stay the same, when they are stars. The least neighbour is a
    pre-aggregated minimum joined back, so a node with very many neighbours is not gathered in one place. Every round is
    written to the shared folder. Loops and repeated edges do no harm; an empty graph gives an empty result. Edges that still
    change after ``most_rounds`` are an error, not a result.
    """
    smaller, larger = F.least("u", "v"), F.greatest("u", "v")
    now = materialise(edges.filter("u != v").select(larger.alias("u"), smaller.alias("v")).distinct(), "edges")
    state = _state(now)
    for _ in range(most_rounds):
        if not state[0]:
            break
        near = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = minima(near, 2 * state[0]).select(F.col("u"), F.least("u", "m").alias("m"))
        large = near.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(_spread(large, 2 * state[0]), "large-star")
        least = minima(large, 2 * state[0])
        small = large.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        past = now
        now = materialise(_spread(small.filter("u != v").distinct(), 2 * state[0]), "small-star")
        discard(past, large)
        last, state = state, _state(now)
        if state == last:
            break
    else:
        raise RuntimeError(f"components: edges still change after {most_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
