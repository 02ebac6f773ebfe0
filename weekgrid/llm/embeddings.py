"""Near-duplicate vectors by random-hyperplane signs in several tables.

Vectors of one label meet in a bucket if their signs agree on one table's
hyperplanes. Inside a bucket all cosines are computed exactly, in tiles of
bounded size; what leaves a tile is a link count per vector and one edge to the
smallest vector of its local component, never the pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from weekgrid.llm.common import stored, table
from weekgrid.llm.components import components
from weekgrid.llm.vectors import sound

COSINE, RECALL, TILE, SEED = 0.93, 0.998, 1024, 7
BITS = (6, 24)


def plan_tables(largest: int, least: float, recall: float, tile: int = TILE) -> tuple[int, int]:
    """Bits and number of tables for a label of ``largest`` classes: so many bits that a
    bucket of unlike vectors is about half a tile, and so many tables that a pair at
    the cosine ``least`` meets in one of them with probability ``recall``."""
    bits = min(max(math.ceil(math.log2(max(2 * largest / tile, 1))), BITS[0]), BITS[1])
    agree = (1 - math.acos(least) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def units(batches):
    """Vectors of length 1 (components divided by the largest one first, so no square
    overflows), and a 128-bit digest of the vector as it was given."""
    for batch in batches:
        vectors = batch.column(batch.num_columns - 1)
        sizes = np.diff(vectors.offsets.to_numpy())
        flat = vectors.flatten().to_numpy(zero_copy_only=False) + 0.0  # no negative zeros
        starts = np.concatenate([[0], np.cumsum(sizes)])
        unit, digests = np.zeros(len(flat)), []
        for d in np.unique(sizes):
            at = starts[np.flatnonzero(sizes == d)][:, None] + np.arange(d)
            x = flat[at] / np.abs(flat[at]).max(1, keepdims=True)
            unit[at] = x / np.sqrt((x * x).sum(1, keepdims=True))
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            digests.append(hashlib.blake2b(flat[a:b].tobytes(), digest_size=16).digest())
        lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(unit))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(digests, pa.binary()), lists], [*batch.schema.names[:-1], "digest", "vector"])


def signatures(tables: int, bits: int, seed: int):
    """Adds to each vector (a list of doubles) the bucket number in every table."""

    def run(batches):
        planes = {}
        for batch in batches:
            vectors = batch.column(batch.num_columns - 1)
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            codes = np.zeros((batch.num_rows, tables), np.int32)
            for d in np.unique(sizes):
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, int(d)]).standard_normal((int(d), tables * bits))
                at = np.flatnonzero(sizes == d)
                signs = (flat[starts[at][:, None] + np.arange(d)] @ planes[d]) > 0
                codes[at] = signs.reshape(len(at), tables, bits) @ (1 << np.arange(bits))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, codes.size + 1, tables, dtype=np.int32)), pa.array(codes.ravel())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "codes"])

    return run


def _groups(label):
    """Smallest member of each row's component in a symmetric boolean matrix."""
    n = len(label)
    root = np.arange(n)
    while True:
        low = np.where(label, root[None, :], n).min(1)
        new = np.minimum(root, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def tiles(least: float):
    """Exact links inside each tile of a partition sorted by tile."""

    def work(rows):
        side, t = rows["side"], rows["tab"][0]
        x, codes, ids, sizes = rows["vector"], rows["codes"], rows["rep"], rows["n"]
        cosine = x @ x.T
        link = cosine >= least
        np.fill_diagonal(link, False)
        if rows["lo"][0] != rows["hi"][0]:
            link &= side[:, None] != side[None, :]
        a, b = np.nonzero(link)
        root = _groups(link | link.T) if len(a) else np.arange(len(ids))
        seen = (codes[a, :t] == codes[b, :t]).any(1)
        count = np.bincount(a[~seen], sizes[b[~seen]], len(ids)).astype(np.int64)
        low = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(low, root, ids)
        keep = (count > 0) | (low[root] != ids)
        return ids[keep], count[keep], low[root][keep]

    def run(batches):
        held = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            part = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in ("label", "dim", "tab", "code", "lo", "hi", "side", "rep", "n")}
            part["codes"] = np.stack(batch.column("codes").to_numpy(zero_copy_only=False))
            part["vector"] = batch.column("vector").to_numpy(zero_copy_only=False)
            if held is not None:
                part = {k: np.concatenate([held[k], v]) for k, v in part.items()}
            turns = [part[k][1:] != part[k][:-1] for k in ("label", "dim", "tab", "code", "lo", "hi")]
            cuts = np.flatnonzero(np.any(turns, axis=0)) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            held = {k: v[last:] for k, v in part.items()}
            yield from emit(part, [0, *cuts.tolist()])
        if held is not None:
            yield from emit(held, [0, len(held["rep"])])

    def emit(part, cuts):
        out = []
        for i, j in zip(cuts, cuts[1:]):
            if j - i > 1:
                rows = {k: v[i:j] for k, v in part.items()}
                rows["vector"] = np.stack(rows["vector"])
                out.append(work(rows))
        if out:
            columns = [np.concatenate(x) for x in zip(*out)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rep", "links", "low"])

    return run


def near_duplicates(
    vectors: DataFrame, least: float = COSINE, recall: float = RECALL, tile: int = TILE, seed: int = SEED,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Equal vectors of one label (by a 128-bit digest) are one class with a size, so copies
    are linked without being compared. Labels may be of any type and are compared as
    text. Vectors that are null, empty, zero, or hold a null or a non-finite component,
    and those with a null label, link with nothing, as do vectors of different lengths. Rows repeated with their id are further members
    of their class. A null id is linked like others, but its component is the
    smallest id that is not null. An empty table gives no rows. A bucket of more
    than ``tile`` classes is split into pairs of tiles, which together compare all
    of it. Bits and tables follow from the classes of the largest label and the wanted
    ``recall`` of pairs at the least cosine (``plan_tables``).
    """
    x = F.transform(vector_col, lambda v: v.cast("double"))
    usable = F.col(label_col).isNotNull() & sound(vector_col) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.when(usable, x).alias("vector"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    linkable = rows.where(F.col("vector").isNotNull()).select("row", "vec_id", "label", "vector")
    linkable = stored(linkable.mapInArrow(units, "row long, vec_id long, label string, digest binary, vector array<double>"), "units")
    classes = stored(
        linkable.groupBy("label", "digest").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first")), "classes"
    )
    largest = classes.groupBy("label").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c").alias("c")).first()["c"] or 0
    bits, tables = plan_tables(largest, least, recall, tile)
    signed = linkable.select("row", "vector").join(classes.select("label", "rep", "n"), F.col("row") == F.col("rep")).select(
        "label", F.size("vector").alias("dim"), "rep", "n", "vector"
    ).mapInArrow(signatures(tables, bits, seed), "label string, dim int, rep long, n long, vector array<double>, codes array<int>")
    signed = stored(signed, "signatures")
    bucket = ["label", "dim", "tab", "code"]
    placed = signed.select("label", "dim", "rep", "n", F.posexplode("codes").alias("tab", "code"))
    sizes = placed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)
    chunks = F.ceil(F.col("members") / tile).cast("int")
    entries = placed.join(sizes, bucket).withColumn("chunks", chunks).withColumn("side", F.pmod(F.hash("rep"), F.col("chunks")).cast("int"))
    entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    tiled = entries.select(
        *bucket, F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "rep", "n"
    ).join(signed.select("rep", "vector", "codes"), "rep")
    key = [*bucket, "lo", "hi"]
    found = tiled.repartition(*key).sortWithinPartitions(*key).mapInArrow(tiles(least), "rep long, links long, low long")
    found = stored(found, "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found, "rep", "low")
    # A component's id is its smallest vector id, not the smallest row number.
    grouped = classes.join(joined.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    smallest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    summary = grouped.join(smallest, "component").join(links, "rep", "left").select(
        "label", "digest", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    linked = linkable.select("row", "label", "digest").join(summary, ["label", "digest"]).select("row", "component_id", "n_links")
    component = F.coalesce("component_id", "vec_id")
    return rows.select("row", "vec_id").join(linked, "row", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
