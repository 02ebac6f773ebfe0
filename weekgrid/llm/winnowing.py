"""Winnowing fingerprints with DataFrame functions only.

Tokens are runs of up to ``TOKEN`` characters without white space; a longer run
has one at each of its characters, the ``TOKEN`` characters from there, so they do
not depend on where the run starts. Every run of ``k`` tokens gets a 64-bit hash,
and of every ``w`` neighbouring hashes the smallest is kept, the rightmost of equal
ones, with its position. Two texts that share a run of ``w + k - 1`` tokens (inside
long runs, ``TOKEN + w + k - 2`` characters) therefore share a fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weekgrid.llm.common import table

K, W, TOKEN = 3, 5, 12


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for each row: a plain nested
    expression would be copied into every use of it inside the lambdas."""
    return F.transform(F.array(value), body)[0]


def tokens(text: Column) -> Column:
    c = r"[^\x20\x09-\x0D]"
    short = rf"(?<!{c}){c}{{1,{TOKEN - 1}}}+(?!{c})"
    # A short run is passed as a whole, a long one by single characters.
    return F.regexp_extract_all(text, F.lit(rf"(?=({short}|{c}{{{TOKEN}}}))(?:{short}|{c})"), F.lit(1))


def gram_hashes(text: Column, k: int = K) -> Column:
    """Hashes of all runs of ``k`` tokens; of the whole, if it has fewer; none without tokens."""

    def grams(t):
        rolled = F.transform(F.sequence(F.lit(0), F.size(t) - k), lambda i: F.xxhash64(*[t[i + j] for j in range(k)]))
        return F.when(F.size(t) >= k, rolled).when(F.size(t) > 0, F.array(F.xxhash64(F.concat_ws(" ", t)))).otherwise(
            F.expr("cast(array() as array<bigint>)")
        )

    return let(F.transform(tokens(text), lambda x: F.xxhash64(x)), grams)


def fingerprint(text: Column, k: int = K, w: int = W) -> Column:
    """Array of (position, hash), ordered by position."""

    def choose(h, back):
        def of(i):
            return let(F.slice(back, F.size(h) - i - w + 1, w), lambda s: i + w - F.array_position(s, F.array_min(s)).cast("int"))

        windows = F.transform(F.sequence(F.lit(0), F.size(h) - w), of)
        whole = F.array(F.size(h) - F.array_position(back, F.array_min(h)).cast("int"))
        places = F.when(F.size(h) >= w, F.array_distinct(windows)).when(F.size(h) > 0, whole).otherwise(
            F.expr("cast(array() as array<int>)")
        )
        return F.transform(places, lambda p: F.struct(p.alias("position"), h[p].alias("hash")))

    return let(gram_hashes(text, k), lambda h: let(F.reverse(h), lambda back: choose(h, back)))


def written(prints: Column) -> Column:
    """``position:hash`` of each, comma-joined, the hash in hexadecimal."""
    return F.array_join(F.transform(prints, lambda p: F.concat_ws(":", p["position"], F.hex(p["hash"]))), ",")


def hashes(prints: Column) -> Column:
    return F.array_distinct(F.transform(prints, lambda p: p["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes; 1 for two empty ones."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / both).cast("double")


def with_next(docs: DataFrame, columns: dict[str, Column], id_col: str, text_col: str, buckets: int) -> DataFrame:
    """Every document with the text of the next one by descending id, and with
    ``columns`` of both as ``name`` and ``next_name``.

    Ids are cut into ranges of similar size; the window runs inside a range, and
    the first document of each range is also the last row of the range before. An
    id, or no id, that would fill several ranges gets as many, and its rows are dealt
    to them by a hash of their text. The driver holds one id per range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    facts = rows.agg(
        F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)] or [0.5], 10_000).alias("bounds"),
        F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("named"),
    ).first()
    bounds = sorted(facts["bounds"] or []) if buckets > 1 else []
    # Range numbers rise with the id, those without one come before all; a bound that is
    # there more than once is an id with many rows.
    lone = 1 + buckets * (facts["n"] - facts["named"]) // max(facts["n"], 1)
    single = sorted(set(bounds))
    first = {b: lone + 2 * i + sum(bounds.count(x) - 1 for x in single[:i]) for i, b in enumerate(single)}
    dealt = lambda k: F.pmod(F.xxhash64("text"), k).cast("int")
    # Looked up in arrays: a chain of conditions would nest as deep as there are ranges.
    listed = lambda values, kind: F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")
    below = F.size(F.filter(listed(single, "long"), lambda b: b < F.col("doc_id")))
    of = lambda values, kind: F.element_at(listed(values, kind), below + 1)
    mine = 1 + dealt(of([bounds.count(b) for b in single] + [1], "int"))
    start = of([first[b] for b in single] + [lone + 2 * len(single) + len(bounds) - len(single)], "int")
    bucket = start + F.when(F.col("doc_id") == of([*single, None], "long"), mine).otherwise(0)
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), dealt(F.lit(lone))).otherwise(bucket))
    # One row per range: its first document follows the last one of the range above.
    # Ids are compared first, so that texts are only compared where ids are equal.
    highest = F.broadcast(rows.groupBy("bucket").agg(F.max("doc_id").alias("top")).withColumnRenamed("bucket", "in_bucket"))
    tops = rows.join(highest, (F.col("bucket") == F.col("in_bucket")) & F.col("doc_id").eqNullSafe(F.col("top")))
    tops = tops.groupBy("bucket", "doc_id").agg(F.min("text").alias("text"))
    above = Window.partitionBy(F.lit(0)).orderBy(F.desc("bucket"))
    whole = above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    top = F.struct("doc_id", "text")
    follow = tops.select("bucket", F.coalesce(F.lead(top).over(above), F.first(top).over(whole)).alias("top"))
    ghosts = follow.select("top.doc_id", "top.text", "bucket", F.lit(True).alias("ghost"))
    both = rows.withColumn("ghost", F.lit(False)).unionByName(ghosts)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ready = both.repartition(parts, "bucket").select("*", *[c.alias(n) for n, c in columns.items()])
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc("doc_id"), "text")
    return (
        ready.select("doc_id", "text", "ghost", *columns, *[F.lead(n).over(order).alias(f"next_{n}") for n in ["text", *columns]])
        .where(~F.col("ghost"))
        .drop("ghost")
    )


def compare(docs: DataFrame, k: int = K, w: int = W, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, one row per input row.

    A null text is empty: no fingerprint, and equal to any other empty one. Texts
    of fewer than ``k`` tokens have one hash of them all. Repeated rows follow
    each other; a null id comes after all others. A single document is its own
    next one. An empty table gives no rows.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = with_next(docs, {"prints": fingerprint(F.col("text"), k, w)}, id_col, text_col, buckets)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    done = pairs.select("doc_id", n.cast("long").alias("n_chars"), "prints", "next_prints", edited.alias("edited"))
    done = done.withColumn("found", let(fingerprint(F.col("edited"), k, w), lambda e: F.struct(
        written(e).alias("text"), hashes(e).alias("hashes"))))
    return done.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("prints")).alias("fingerprint"), F.col("found.text").alias("edited_fingerprint"),
        likeness(hashes(F.col("prints")), F.col("found.hashes")).alias("near_edited"),
        likeness(hashes(F.col("prints")), hashes(F.col("next_prints"))).alias("near_next"),
    )


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare(table(spark, sf_dir, "documents"))
