"""Store segmentation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from weekgrid.functions.columns import ratio, zero_if_null
from weekgrid.session import stored

FEATURES = ["avg_weekly_sales", "store_size", "avg_weekly_markdown"]
# Archetype names from the largest to the smallest cluster centre by store size.
ARCHETYPES = ["Supercenter (Flagship)", "Standard Discount Store", "Neighborhood Market (Express)"]
TILE = 2048


def profiles(gold: DataFrame) -> DataFrame:
    """One row per store: mean sales, size and mean markdown."""
    return gold.groupBy("store").agg(
        F.avg("weekly_sales").alias("avg_weekly_sales"),
        F.max("store_size").alias("store_size"),
        F.avg(zero_if_null(F.col("total_markdown"))).alias("avg_weekly_markdown"),
    )


def standardised(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Adds ``<name>_scaled`` with mean 0 and population deviation 1 (0 for a constant)."""
    names = names or FEATURES
    figures = [
        e
        for c in names
        for e in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"))
    ]
    figure = df.agg(F.struct(*figures).alias("f")).scalar()
    return df.withColumns(
        {
            f"{c}_scaled": zero_if_null(ratio(F.col(c) - figure[f"{c}_mean"], figure[f"{c}_std"]))
            for c in names
        }
    )


def _points(store_profiles: DataFrame) -> DataFrame:
    """Standardised profiles with a vector column, written once: a fit reads them
    in every iteration, in as many partitions as their size asks for."""
    scaled = stored(standardised(store_profiles), "store-points")
    names = [f"{c}_scaled" for c in FEATURES]
    return VectorAssembler(inputCols=names, outputCol="features").transform(scaled)


def kmeans(store_profiles: DataFrame, k: int = 3, seed: int = 42) -> DataFrame:
    """Store profiles with ``cluster`` 0..k-1, numbered from the largest mean
    store size down, so the number does not depend on the fit's own order."""
    points = _points(store_profiles)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="fitted", maxIter=100).fit(points)
    size_at = FEATURES.index("store_size")
    by_size = sorted(range(k), key=lambda i: -model.clusterCenters()[i][size_at])
    number = F.create_map(*[F.lit(v) for pair in ((old, new) for new, old in enumerate(by_size)) for v in pair])
    return model.transform(points).select(
        "store", *FEATURES, *[f"{c}_scaled" for c in FEATURES], number[F.col("fitted")].alias("cluster")
    )


def archetypes(clustered: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Adds the archetype of a cluster; a cluster beyond the names gets NULL."""
    names = names or ARCHETYPES
    label = F.create_map(*[F.lit(v) for pair in enumerate(names) for v in pair])
    return clustered.withColumn("archetype", F.try_element_at(label, F.col("cluster")))


def centres(clustered: DataFrame) -> DataFrame:
    """Cluster centres in original units."""
    return clustered.groupBy("cluster").agg(
        F.count("*").alias("stores"), *[F.avg(c).alias(c) for c in FEATURES]
    )


def elbow(store_profiles: DataFrame, most: int = 10, seed: int = 42) -> DataFrame:
    """(k, inertia) for k = 1..most; k = 1 is the total variance."""
    points = _points(store_profiles)
    spark = points.sparkSession
    names = [f"{c}_scaled" for c in FEATURES]
    total = points.agg(F.sum(sum(F.col(c) * F.col(c) for c in names)).alias("s")).first()["s"]
    costs = [(1, float(total))]
    for k in range(2, most + 1):
        costs.append((k, float(KMeans(k=k, seed=seed, maxIter=100).fit(points).summary.trainingCost)))
    return spark.createDataFrame(costs, "k int, inertia double")


def nearby(placed: DataFrame, width: int) -> DataFrame:
    """``placed`` (id, cluster, v of ``width`` numbers) once per cluster ``near`` that a
    point has to be compared with: its own and those that may be the nearest other one.

    A point's mean distance to a cluster is at least its distance to the centre, and at
    most the root of that squared plus the cluster's mean squared radius (Jensen's
    inequality both times). A cluster whose lower bound is above another one's upper
    bound is not the nearest. The driver holds one centre and radius per cluster.
    """
    known = placed.where(F.col("cluster").isNotNull())
    centres = known.groupBy("cluster").agg(F.array(*[F.avg(F.col("v")[i]) for i in range(width)]).alias("m"))
    apart = F.zip_with("v", "m", lambda x, y: (x - y) * (x - y))
    spread = F.aggregate(apart, F.lit(0.0), lambda total, x: total + x)
    rows = known.join(centres, "cluster").groupBy("cluster").agg(F.first("m").alias("m"), F.avg(spread).alias("radius")).orderBy("cluster").collect()
    names = [r["cluster"] for r in rows]
    middle, radius = np.array([r["m"] for r in rows], float).reshape(len(rows), width), np.array([r["radius"] for r in rows], float)

    def run(batches):
        for pdf in batches:
            if pdf.empty or not names:
                continue
            v = np.stack(pdf["v"].to_list()).astype(float)
            low = np.column_stack([np.sqrt(((v - m) ** 2).sum(1)) for m in middle])
            own = pdf["cluster"].to_numpy()[:, None] == np.array(names, object)
            high = np.where(own, np.inf, np.sqrt(low**2 + radius)).min(1)
            slack = 1e-9 * (np.sqrt((v**2).sum(1)) + np.sqrt((middle**2).sum(1)).max())  # of rounded bounds
            asked = own | ~(low > (high * (1 + 1e-9) + slack)[:, None])
            who, near = np.nonzero(asked)
            yield pdf.iloc[who].assign(near=np.array(names, object)[near])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.schema)
    return placed.mapInPandas(run, f"{fields}, near string")


def silhouette(points: DataFrame, key: str, names: list[str], cluster: str) -> DataFrame:
    """(key, cluster, silhouette) by exact Euclidean distance.

    A point is compared with its own cluster and with those that bounds leave as the
    nearest other one; points of clusters farther away are never met. No distance
    leaves a task: the points of a cluster and the points that ask for it are cut
    into tiles of about ``TILE``, a task meets two tiles and returns one distance sum
    per point. Tiles are drawn by hash, so a large cluster spreads out. A cluster of
    one point has silhouette 0, as has a point without a cluster.
    """
    vector = F.array(*[F.col(c).cast("double") for c in names])
    placed = stored(points.select(F.col(key).alias("id"), F.col(cluster).cast("string").alias("cluster"), vector.alias("v")), "points")
    asked = stored(nearby(placed, len(names)), "asked")
    tiles = lambda n: F.ceil(F.col(n) / F.lit(TILE)).cast("int")
    members = placed.where("cluster IS NOT NULL").groupBy(F.col("cluster").alias("near")).agg(F.count("*").alias("members"))
    askers = asked.groupBy("near").agg(F.count("*").alias("askers"))
    sizes = stored(members.join(askers, "near").withColumns({"rows": tiles("askers"), "columns": tiles("members")}), "cluster-sizes")
    # A tile of those who ask meets every tile of the cluster, and the other way round.
    salt = F.xxhash64("id")
    asks = asked.join(sizes, "near").select(
        "id", "cluster", "v", "near", F.pmod(salt, "rows").alias("i"), F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"), F.lit(True).alias("asks")
    )
    told = placed.withColumn("near", F.col("cluster")).join(sizes, "near").select(
        "id", "cluster", "v", "near", F.explode(F.sequence(F.lit(0), F.col("rows") - 1).cast("array<long>")).alias("i"), F.pmod(salt, "columns").cast("int").alias("j"), F.lit(False).alias("asks")
    )

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        if left.empty or right.empty:
            return pd.DataFrame(columns=["id", "cluster", "near", "total"])
        a, b = np.stack(left["v"].to_list()), np.stack(right["v"].to_list())
        total = np.concatenate(
            [np.sqrt(((a[s : s + 256, None, :] - b[None, :, :]) ** 2).sum(-1)).sum(1) for s in range(0, len(a), 256)]
        )
        return left[["id", "cluster", "near"]].assign(total=total)

    key_type = points.schema[key].dataType.simpleString()
    partial = asks.unionByName(told).groupBy("near", "i", "j").applyInPandas(
        sums, f"id {key_type}, cluster string, near string, total double"
    )
    per_cluster = partial.groupBy("id", "cluster", "near").agg(F.sum("total").alias("total")).join(sizes.select("near", "members"), "near")
    own = F.col("near") == F.col("cluster")
    figures = per_cluster.groupBy("id", "cluster").agg(
        F.max(F.when(own, F.col("members"))).alias("size"),
        F.max(F.when(own, ratio(F.col("total"), F.col("members") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("members"))).alias("b"),
    )
    score = ratio(F.col("b") - F.col("a"), F.greatest("a", "b"))
    return figures.select(
        F.col("id").alias(key),
        "cluster",
        F.when(F.col("size") == 1, F.lit(0.0)).otherwise(zero_if_null(score)).alias("silhouette"),
    )
