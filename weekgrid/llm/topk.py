"""Exact top-k inner products by a pivot-distance index.

A candidate v gets one more component sqrt(M - v.v), where M is the largest v.v,
and a query q gets a zero there. Then |q - v|^2 = q.q + M - 2 q.v, so the highest
scores are the nearest points of a metric space. Candidates are keyed by their
nearest pivot and their distance to it and cut into annuli of bounded size.
Queries of one pivot form tiles; a tile meets annuli in the order of the least
distance that the triangle inequality leaves possible, in growing rounds, and
stops where even that distance cannot reach its k-th score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weekgrid.llm.common import stored, table, tidy
from weekgrid.llm.order import ranked
from weekgrid.llm.vectors import matrix, sound

K, SCALE, EVERY = 20, 64, 20
BLOCK, TILE = 512, 256
SAMPLE, PIVOTS, SEED = 4096, 256, 11
GROWTH = 8
SLACK = 1e-6
EXACT = 2.0**53
HIT = "q long, q_id long, v long, v_id long, score long"


def choose(sample, count: int, seed: int):
    """Up to ``count`` rows of a sample as pivots, each drawn by its squared distance
    to the ones before it."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(sample)))]
    gap = ((sample - sample[chosen[0]]) ** 2).sum(1)
    while len(chosen) < count and gap.sum() > 0:
        chosen.append(int(rng.choice(len(sample), p=gap / gap.sum())))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


class Space:
    """Integer vectors, the pivots, and distances between them; small enough to be
    broadcast: at most ``PIVOTS`` vectors."""

    def __init__(self, width: int, kind: str, most: float, pivots):
        self.width, self.kind, self.most, self.pivots = width, kind, most, pivots
        self.lift = np.sqrt(np.maximum(most - (pivots**2).sum(1), 0))

    def read(self, packed) -> np.ndarray:
        return np.frombuffer(b"".join(packed), self.kind).reshape(len(packed), self.width)

    def distances(self, x, query: bool):
        own = (x.astype(float) ** 2).sum(1)
        if query:
            squared = own[:, None] + self.most - 2 * (x @ self.pivots.T)
        else:
            lift = np.sqrt(np.maximum(self.most - own, 0))
            squared = 2 * self.most - 2 * (x @ self.pivots.T + lift[:, None] * self.lift)
        return np.sqrt(np.maximum(squared, 0)), own

    def highest(self, own, gap):
        """The highest score that a query of squared length ``own`` may have beyond a
        gap of distances; roundings of the distances are on the safe side."""
        gap = np.maximum(gap - SLACK * (np.sqrt(self.most) + np.sqrt(own)), 0)
        return (own + self.most - gap**2) / 2 + SLACK * (own + self.most) + 1


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int, is_query: Column) -> tuple[DataFrame, int, str]:
    """Sound rows with an id, as packed integers: row, vec_id, query, x; the width and the kind of integer."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("query"),
        F.when(sound(vector_col), F.transform(vector_col, lambda v: v.cast("double"))).alias("vector"),
    ).where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    largest = F.array_max(F.transform("vector", lambda v: F.abs(v)))
    found = rows.agg(F.max(F.size("vector")).alias("width"), F.max(largest).alias("most")).first()
    width, most = found["width"] or 0, (found["most"] or 0.0) * scale + 1
    if most >= 2**31:
        raise ValueError(f"components of more than {2**31 // scale} have scores beyond 64 bits")
    kind = "<i2" if most < 2**15 else "<i4"

    def run(batches):
        for batch in batches:
            x = np.floor(matrix(batch.column(2), width) * scale).astype(kind)
            raw = pa.array([r.tobytes() for r in x], pa.binary())
            square = pa.array((x.astype(float) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), raw, square], ["vec_id", "query", "x", "square"])

    packed = rows.mapInArrow(run, "vec_id long, query boolean, x binary, square double")
    return stored(packed.withColumn("row", F.monotonically_increasing_id()), "packed"), width, kind


def keyed(rows: DataFrame, space: Space, query: bool) -> DataFrame:
    """Adds the nearest pivot and the distance to it."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                distance, _ = space.distances(space.read(batch.column(2).to_pylist()), query)
                cell = distance.argmin(1)
                near = distance[np.arange(len(cell)), cell]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(near)], ["row", "vec_id", "x", "cell", "distance"]
                )

    return rows.select("row", "vec_id", "x").mapInArrow(run, "row long, vec_id long, x binary, cell int, distance double")


def cut(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Annuli: of each cell, ``size`` rows at a time by distance, each as one row with its range of distances."""
    placed = ranked(rows, ["cell"], ["distance", "row"], name)
    member = F.struct("vec_id", "row", "x")
    return stored(placed.groupBy("cell", F.floor(F.col("rank") / size).alias("ring")).agg(
        F.min("distance").alias("low"), F.max("distance").alias("high"), F.sort_array(F.collect_list(member)).alias("members")
    ), name)


def reach(tiles: DataFrame, space: Space) -> DataFrame:
    """Per tile and pivot the range of its queries' distances to the pivot."""
    n = len(space.pivots)

    def run(batches):
        for batch in batches:
            for cell, ring, members in zip(batch.column(0), batch.column(1), batch.column(2)):
                x = space.read(members.values.field("x").to_pylist())
                distance, own = space.distances(x, True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cell.as_py()] * n, pa.int32()), pa.array([ring.as_py()] * n, pa.int64()), pa.array(range(n), pa.int32()),
                     pa.array(distance.min(0)), pa.array(distance.max(0)), pa.array([own.max()] * n)],
                    ["q_cell", "q_ring", "cell", "near", "far", "own"],
                )

    return tiles.select("cell", "ring", "members").mapInArrow(run, "q_cell int, q_ring long, cell int, near double, far double, own double")


def meet(pairs: DataFrame, space: Space, k: int) -> DataFrame:
    """The up to ``k`` best of an annulus for each query of a tile that reach what it
    has (``least``, null while it has fewer than ``k``)."""

    def one(cell, low, high, members, queries, least):
        ids, rows = (members.field(c).to_numpy() for c in ("vec_id", "row"))
        x = space.read(members.field("x").to_pylist())
        q_ids, q_rows = (queries.field(c).to_numpy() for c in ("vec_id", "row"))
        q = space.read(queries.field("x").to_pylist())
        distance, own = space.distances(q, True)
        d = distance[:, cell]
        may = space.highest(own, np.maximum(np.maximum(low - d, d - high), 0)) >= least
        q, q_ids, q_rows, least = q[may], q_ids[may], q_rows[may], least[may]
        # Integers below 2**53 are exact as doubles, and so are all their partial sums.
        kind = np.float64 if space.most < EXACT else np.int64
        score = q.astype(kind) @ x.astype(kind).T
        good = (score >= least[:, None]) & (q_rows[:, None] != rows)
        out = []
        for i in np.flatnonzero(good.any(1)):
            at = np.flatnonzero(good[i])
            # Members are sorted by id, so a stable sort leaves ties in their order.
            at = at[np.argsort(-score[i, at], kind="stable")[:k]]
            out.append((np.full(len(at), q_rows[i]), np.full(len(at), q_ids[i]), rows[at], ids[at], score[i, at].astype(np.int64)))
        return [np.concatenate(c) for c in zip(*out)] if out else None

    def run(batches):
        for batch in batches:
            scalars = [batch.column(i).to_pylist() for i in range(3)]
            for i, (cell, low, high) in enumerate(zip(*scalars)):
                least = batch.column(5)[i].values.to_numpy(zero_copy_only=False).astype(float)
                found = one(cell, low, high, batch.column(3)[i].values, batch.column(4)[i].values, np.where(np.isnan(least), -np.inf, least))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["q", "q_id", "v", "v_id", "score"])

    return pairs.select("cell", "low", "high", "members", "queries", "least").mapInArrow(run, HIT)


@tidy
def search(
    vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, block: int = BLOCK, tile: int = TILE,
    pivots: int = PIVOTS, sample: int = SAMPLE, growth: int = GROWTH, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` rows with the highest integer
    inner products with each query, ties to the smaller id; all where there are fewer.

    Components are floor(scale * x). A row that is null, holds a null or a non-finite
    component, or has no id takes no part. A query's own row is no candidate; other
    rows with its id are, and each of them that is a query gets its own ranks. A
    shorter vector counts as followed by zeros, an empty one as zeros. An empty table,
    or one without queries, gives no rows. Components must leave scores within 64
    bits, or the query fails. Pivots come from ``sample`` rows, fewer for small
    tables; they decide cost only.
    """
    rows, width, kind = scaled(vectors, id_col, vector_col, scale, is_query)
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max("square").alias("most")).first()
    if (facts["most"] or 0) >= 2.0**63:
        raise ValueError("scores beyond 64 bits")
    drawn = rows.orderBy(F.xxhash64("row"), "row").limit(sample).select("x").collect()
    count = max(1, min(pivots, round(facts["n"] ** 0.5 / 8)))
    start = np.frombuffer(b"".join(r["x"] for r in drawn), kind).reshape(len(drawn), width).astype(float)
    space = Space(width, kind, facts["most"] or 0.0, choose(start, count, SEED) if len(start) else np.zeros((1, width)))

    blocks = cut(keyed(rows, space, False), block, "annuli")
    tiles = cut(keyed(rows.where("query"), space, True), tile, "tiles").select("cell", "ring", "members")
    gap = F.greatest(F.col("low") - F.col("far"), F.col("near") - F.col("high"), F.lit(0.0))
    safe = F.greatest(gap - SLACK * (F.lit(space.most**0.5) + F.sqrt("own")), F.lit(0.0))
    bound = (F.col("own") + space.most - safe * safe) / 2 + SLACK * (F.col("own") + space.most) + 1
    nearest = Window.partitionBy("q_cell", "q_ring").orderBy(F.desc("bound"), "gap", F.desc(F.col("cell") == F.col("q_cell")), "cell", "ring")
    order = stored(
        reach(tiles, space).join(blocks.select("cell", "ring", "low", "high"), "cell").withColumn("gap", gap).withColumn("bound", bound)
        .withColumn("place", F.row_number().over(nearest)).select("q_cell", "q_ring", "cell", "ring", "bound", "place"),
        "order",
    )
    asked = tiles.select(F.col("cell").alias("q_cell"), F.col("ring").alias("q_ring"), F.col("members").alias("queries"))
    each = stored(asked.select("q_cell", "q_ring", F.posexplode("queries.row").alias("at", "q")), "queries")
    best = stored(rows.select(*[F.lit(0).cast("long").alias(c) for c in ("q", "q_id", "v", "v_id", "score")]).limit(0), "best")
    first, last = 1, 2
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "v_id", "v"))
    while True:
        kth = best.groupBy("q").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
        least = each.join(kth, "q", "left").groupBy("q_cell", "q_ring").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("at", F.coalesce(F.col("least").cast("double"), F.lit(float("-inf"))).alias("x")))), lambda s: s["x"]).alias("least")
        )
        ahead = order.where(F.col("place") >= first).join(least, ["q_cell", "q_ring"]).where(F.col("bound") >= F.array_min("least"))
        ahead = stored(ahead, "ahead")
        if not ahead.limit(1).count():
            break
        now = ahead.where(F.col("place") < last).drop("bound", "place").join(asked, ["q_cell", "q_ring"]).join(blocks, ["cell", "ring"])
        hits = best.unionByName(meet(now.repartition("q_cell", "q_ring", "cell", "ring"), space, k))
        best = stored(hits.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank"), "best")
        first, last = last, last * growth
    return best.select(F.col("q_id").alias("query_id"), rank.cast("int").alias("rank"), F.col("v_id").alias("vec_id"), "score")


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


ORACLE_SQL = """
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.x, v.x) AS BIGINT) AS score
  FROM scaled q JOIN scaled v ON q.vec_id <> v.vec_id
  WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""
