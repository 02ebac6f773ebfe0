"""Exact Jaccard join of word-shingle sets in a metric space.

Jaccard distance is a metric, but unrelated documents are all at distance 1 from
any pivot, so pivots chosen from the whole corpus would separate nothing. The
regions of the first level are therefore the shingles of each document's prefix:
in one global order (frequent shingles last, else by hash) two documents that
link share one of their first ``n - ceil(t n) + 1`` shingles. Within a region
the metric method holds: the pivot's distances are computed, its ball joins it,
the triangle inequality leaves only a window of boundary documents to compare
with the rest, and the rest is joined recursively around further pivots, down to
small regions whose remaining pairs are compared directly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weekgrid.llm.common import in_batches, rows_of, stored, table, tidy
from weekgrid.llm.components import components
from weekgrid.llm.shingles import shingle_sets
from weekgrid.llm.words import mix

WORDS, PERCENT = 5, 75
SAMPLE, HOT_IN_SAMPLE, HOT = 16, 3, 200_000
LEAF, ROUNDS = 128, 3
BACK, BITMAP = 3, 4
PLACES = 1 << 20
BATCH, READ, CHUNK = "2m", 512, 250_000  # bytes a worker gets, rows read, and bytes of text hashed at once


def described(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n (set size), a 128-bit digest of the set, and for one set in
    ``SAMPLE``, chosen by digest, its hashes."""

    def run(batches):
        for (doc_id,), texts in rows_of(batches, CHUNK):
            text, value = shingle_sets(texts, words)
            n = np.bincount(text, minlength=len(texts))
            digests = []
            for salt in (1, 2):
                sums = np.zeros(len(texts) + 1, np.uint64)
                bounds = np.concatenate([[0], np.cumsum(n)])
                running = np.concatenate([[np.uint64(0)], np.cumsum(mix(value + np.uint64(salt)), dtype=np.uint64)])
                sums = running[bounds[1:]] - running[bounds[:-1]]
                digests.append(sums)
            chosen = digests[0] % np.uint64(SAMPLE) == 0
            size = np.where(chosen, n, 0)
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array(n.astype(np.int64)), *[pa.array(d.view(np.int64)) for d in digests],
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(value[chosen[text]].view(np.int64)))],
                ["doc_id", "n", "d1", "d2", "some"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, d1 long, d2 long, some array<long>")


def prefixes(docs: DataFrame, hot: np.ndarray, words: int, percent: int, key_only: bool) -> DataFrame:
    """(s, doc_id, n, rank): a document's prefix shingles as 48-bit numbers, with
    its set size and the shingle's place in the global order, from 0."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)  # at most HOT numbers

    def run(batches):
        frequent = shared.value
        for (doc_id,), texts in rows_of(batches, CHUNK):
            text, value = shingle_sets(texts, words)
            n = np.bincount(text, minlength=len(texts))
            length = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
            first = np.concatenate([[0], np.cumsum(n)])[:-1]
            late = np.zeros(len(value), bool)
            if len(frequent):
                late = frequent[np.minimum(np.searchsorted(frequent, value), len(frequent) - 1)] == value
            # Values are sorted within a text; frequent ones move behind the others.
            early = np.cumsum(~late) - ~late
            early -= early[np.minimum(first, max(len(value) - 1, 0))][text] if len(value) else 0
            total_early = np.bincount(text, ~late, len(texts)).astype(np.int64)
            at = np.arange(len(value)) - first[text]
            rank = np.where(late, total_early[text] + at - early, early)
            keep = rank < length[text]
            s = (value[keep] >> np.uint64(16)).view(np.int64)
            if key_only:
                yield pa.RecordBatch.from_arrays([pa.array(s)], ["s"])
            else:
                who = text[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s), doc_id.take(pa.array(who)), pa.array(n[who]), pa.array(rank[keep])], ["s", "doc_id", "n", "rank"]
                )

    return docs.mapInArrow(run, "s long" if key_only else "s long, doc_id long, n long, rank long")


def wanted(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The texts whose id may be in a pair, so that the others are not shuffled. Ids
    count as one of ``PLACES`` numbers, which bounds the broadcast; texts that share a
    number with one that is wanted pass too, and a join on the ids follows."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(PLACES)).alias("place")
    held = pairs.select(F.explode(F.array("a", "b")).alias("id")).select(place("id")).distinct()
    return texts.select("*", place("doc_id")).join(F.broadcast(held), "place", "left_semi").drop("place")


def overlaps(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Adds ``shared``, the exact intersection size, to pairs (a, b), a stored table."""

    def run(batches):
        for (a, b, other), texts_b in rows_of(batches, CHUNK):
            n = len(texts_b)
            text, value = shingle_sets([t.as_py() for t in other.cast(pa.large_binary())] + texts_b, words)
            bounds = np.searchsorted(text, np.arange(2 * n + 1))
            shared = [
                len(np.intersect1d(value[bounds[i] : bounds[i + 1]], value[bounds[n + i] : bounds[n + i + 1]], assume_unique=True))
                for i in range(n)
            ]
            yield pa.RecordBatch.from_arrays([a, b, pa.array(shared, pa.int64())], ["a", "b", "shared"])

    texts = wanted(texts, pairs)
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    found = both.mapInArrow(run, "a long, b long, shared long").groupBy("a", "b").agg(F.max("shared").alias("shared"))
    return pairs.join(found, ["a", "b"])


def signed(rows: DataFrame) -> DataFrame:
    """Adds to every prefix shingle the ``BACK`` ones before it, and of the
    document's shingles here the number ``k`` and a bitmap. Two sets differ at
    least where their bitmaps do."""
    mine = Window.partitionBy("x")
    order = mine.orderBy("rank", "s")
    place = F.pmod(F.xxhash64("s"), F.lit(64 * BITMAP))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    return rows.select(
        "*", F.count(F.lit(1)).over(mine).alias("k"),
        *[F.bit_or(F.when(F.floor(place / 64) == i, bit).otherwise(F.lit(0).cast("long"))).over(mine).alias(f"bits{i}") for i in range(BITMAP)],
        *[F.lag("s", i + 1).over(order).alias(f"back{i}") for i in range(BACK)],
    )


@tidy
@in_batches(BATCH, READ)
def jaccard_join(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, leaf: int = LEAF, rounds: int = ROUNDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Documents link when 100 * shared >= percent * union of their distinct
    shingles (A-Z lower-cased; all words as one shingle where there are fewer
    than ``words``). Null texts and texts without words have no shingles and link
    with nothing. Equal sets are one node. Rows that share an id are versions of
    one document, which links if one of them does; a null id links with nothing
    and has no component. An empty table gives no rows. The broadcast list of
    frequent shingles only orders prefixes; no result depends on it.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = stored(described(source, words), "sets")
    nodes = sets.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = stored(nodes.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("some").alias("some"), F.count(F.lit(1)).alias("copies")), "classes")
    frequent = classes.select(F.explode("some").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= HOT_IN_SAMPLE)
    hot = np.array([r["s"] for r in frequent.orderBy(F.desc("c"), "s").limit(HOT).select("s").collect()], np.int64).view(np.uint64)
    hot.sort()

    named = source.where(F.col("doc_id").isNotNull())
    repeated = prefixes(named, hot, words, percent, True).groupBy("s").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("s")
    repeated = stored(repeated, "repeated")  # a plain table, so that a skewed join can be split
    rows = prefixes(named, hot, words, percent, False).join(repeated, "s")
    # Copies of a set have the same prefix: only the class representatives stay.
    reps = classes.select(F.col("rep").alias("doc_id"), F.col("n"))
    regions = stored(rows.join(reps, ["doc_id", "n"]).distinct(), "regions")
    regions = regions.select("s", F.col("doc_id").alias("x"), "n", "rank")

    near = lambda a, b: F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)
    linked = F.lit(100) * F.col("shared") >= F.lit(percent) * (F.col("n_a") + F.col("n_b") - F.col("shared"))
    links = stored(classes.select(F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0), "links")
    part = None
    active = regions.withColumn("beyond", F.lit(0))
    direct = None
    for step in range(rounds):
        # From the second round on a document that no ball of its region has reached.
        pivots = active.groupBy("s").agg(F.min(F.struct("beyond", "x", "n")).alias("p"), F.count(F.lit(1)).alias("c")).where("c > 1")
        around = stored(active.join(pivots, "s").select("s", "x", "n", "rank", F.col("p.x").alias("p"), F.col("p.n").alias("n_p")), "around")
        pairs = around.where((F.col("x") != F.col("p")) & near(F.col("n"), F.col("n_p"))).select(
            F.col("x").alias("a"), F.col("p").alias("b"), F.col("n").alias("n_a"), F.col("n_p").alias("n_b")
        ).distinct()
        measured = stored(overlaps(stored(pairs, "pairs"), named, words), "distances")
        # Groups so far and the new links, not all links again.
        part = components(links.unionByName(measured.where(linked).select("a", "b")))
        links = part.select(F.col("node").alias("a"), F.col("component").alias("b"))
        # Distances to the pivot; a lower bound where the sizes rule a link out.
        gap = F.when(F.col("x") == F.col("p"), 0.0).otherwise(F.coalesce(
            1 - F.col("shared") / (F.col("n") + F.col("n_p") - F.col("shared")), 1 - F.least("n", "n_p") / F.greatest("n", "n_p")))
        at = around.join(measured.select(F.col("a").alias("x"), F.col("b").alias("p"), "shared"), ["x", "p"], "left")
        # What was not measured may be as far as 1, so it cannot leave the window.
        far = F.when((F.col("x") == F.col("p")) | F.col("shared").isNotNull(), gap).otherwise(1.0)
        at = at.withColumn("gap", gap).withColumn("far", far)
        at = at.join(part.select(F.col("node").alias("x"), F.col("component").alias("c_x")), "x", "left")
        at = at.join(part.select(F.col("node").alias("p"), F.col("component").alias("c_p")), "p", "left")
        at = at.withColumn("inside", F.coalesce("c_x", "x") == F.coalesce("c_p", "p"))
        nearest = at.where(~F.col("inside")).groupBy("s").agg(F.min("gap").alias("nearest"), F.count(F.lit(1)).alias("outside"))
        # The window: what is inside stays only if it may link with something outside.
        # The pivot goes, it has been compared with all; its distances are rounded,
        # so the window is opened by a little.
        stay = at.join(nearest, "s").where(
            (F.col("x") != F.col("p")) & (~F.col("inside") | (F.col("far") >= F.col("nearest") - (1 - percent / 100) - 1e-9))
        ).select("s", "x", "n", "rank", F.col("inside").cast("int").alias("beyond"))
        sizes = stay.groupBy("s").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        kept = stored(stay.join(sizes, "s"), "rest")
        small = kept.where((F.col("c") <= leaf) | F.lit(step == rounds - 1)).drop("c", "beyond")
        direct = small if direct is None else direct.unionByName(small)
        active = kept.where(F.col("c") > leaf).drop("c")
        if active.limit(1).count() == 0:
            break

    group = part.select(F.col("node").alias("x"), F.col("component").alias("c"))
    left = stored(signed(direct.join(group, "x", "left").withColumn("c", F.coalesce("c", "x"))), "direct")
    right = left.select(*[F.col(k).alias(k if k == "s" else f"{k}_b") for k in left.columns])
    n, n_b = F.col("n"), F.col("n_b")
    enough = lambda most: F.lit(100) * most >= F.lit(percent) * (n + n_b - most)
    # Skipped where one of the shingles just before is common too: the pair has met
    # there already, and the first time it meets nothing is skipped.
    again = F.lit(False)
    for i in range(BACK):
        for j in range(BACK):
            again |= F.col(f"back{i}") == F.col(f"back{j}_b")
    # In common at most what follows the first common shingle in both; and within
    # the prefixes at most what two bitmaps of them leave possible.
    differ = sum((F.bit_count(F.col(f"bits{i}").bitwiseXOR(F.col(f"bits{i}_b"))) for i in range(BITMAP)), F.lit(0))
    within = F.floor((F.col("k") + F.col("k_b") - differ) / 2)
    beyond = F.floor((F.lit(percent) * F.greatest(n, n_b) + 99) / 100) - 1
    met = left.join(right, "s").where(
        (F.col("x") < F.col("x_b")) & (F.col("c") != F.col("c_b")) & near(n, n_b)
        & enough(F.least(n - F.col("rank"), n_b - F.col("rank_b"))) & enough(within + beyond)
        & ~F.coalesce(again, F.lit(False))
    )
    pairs = stored(met.select(F.col("x").alias("a"), F.col("x_b").alias("b"), n.alias("n_a"), n_b).distinct(), "pairs")
    more = overlaps(pairs, named, words).where(linked).select("a", "b")
    whole = components(links.unionByName(more))
    member = sets.join(classes.select("n", "d1", "d2", "rep"), ["n", "d1", "d2"], "left")
    found = member.join(whole.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))
