"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weekgrid.llm.common import stored, tidy

EDGES = 50_000  # a task's share of a small table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node hands its smallest neighbour (or itself) to its larger, or its
    smaller, neighbours. A hub is only ever aggregated and joined, never gathered."""
    if large:
        ways = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        ways = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    if large:
        out = ways.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = ways.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where(F.col("a") != F.col("b")).distinct()


@tidy
def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest
    node. Each round is a stored table; rounds grow with the logarithm of the
    number of nodes. Self-loops and repeated edges change nothing."""
    now = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a") != F.col("b")).distinct(), "edges")

    def digest(df):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def dealt(df):
        # As many tasks as the last count of edges needs: each writes a file, and for a
        # file on a local disk an executor starts processes of its own size.
        return df.coalesce(max(1, -(-before[0] // EDGES)))

    before = digest(now)
    while True:
        now = stored(dealt(_star(_star(now, True), False)), "stars")
        after = digest(now)
        if after == before:
            break
        before = after
    return dealt(now.select(F.col("a").alias("node"), F.col("b").alias("component"))).unionByName(
        dealt(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    )
