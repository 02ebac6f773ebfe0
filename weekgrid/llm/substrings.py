"""Substring dedup on a compacted De Bruijn graph of word k-mers.

The edges of the graph are the windows of ``k`` words. Windows of a document that
follow each other and share their smallest inner ``q``-word run (their anchor)
form one nonbranching piece; equal windows always have equal anchors, so pieces
with an anchor that occurs once hold no repeated window and drop out, and only
repeated pieces go on. Pieces with the same words compact to one edge with one
earliest place. Where an anchor has several different pieces, the paths branch,
and their windows are compared one by one. Spans whose sources follow each other
are compacted again, and each is verified on the words at its source.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from weekgrid.llm.common import rows_of, stored, table, tidy
from weekgrid.llm.words import WORD_STEP, Runs, Words

K, ANCHOR = 20, 8


def anchors(words: Words, runs: Runs, k: int, q: int):
    """Pieces as (text, first window, windows, hash of the anchor, hash of all words)."""
    n = len(words.hash)
    if n < k:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    i = np.arange(n - q + 1)
    g = runs.run(i, i + q)
    width, windows = k - q + 1, n - k + 1
    least = g[:windows].copy()
    for o in range(1, width):
        np.minimum(least, g[o : o + windows], out=least)
    pos = np.zeros(windows, np.int64)
    for o in range(width - 1, -1, -1):  # the leftmost of equal ones
        at = np.flatnonzero(g[o : o + windows] == least)
        pos[at] = at + o
    whole = words.text_of[:windows] == words.text_of[k - 1 :]
    new = whole.copy()
    new[1:] &= ~whole[:-1] | (pos[1:] != pos[:-1])
    first = np.flatnonzero(new)
    last = whole.copy()
    last[:-1] &= ~whole[1:] | (pos[1:] != pos[:-1])
    last = np.flatnonzero(last)
    return words.text_of[first], first, last - first + 1, g[pos[first]], runs.run(first, last + k)


def pieces(docs: DataFrame, k: int, q: int, key_only: bool) -> DataFrame:
    def run(batches):
        for (doc_id,), texts in rows_of(batches):
            words = Words(texts)
            text, first, n, a, v = anchors(words, Runs(words.hash, WORD_STEP), k, q)
            a = pa.array(a.view(np.int64))
            if key_only:
                yield pa.RecordBatch.from_arrays([a], ["a"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [a, pa.array(v.view(np.int64)), doc_id.take(pa.array(text)), pa.array(first - words.first[text]), pa.array(n)],
                    ["a", "v", "doc_id", "start", "n"],
                )

    return docs.mapInArrow(run, "a long" if key_only else "a long, v long, doc_id long, start long, n long")


def with_places(docs: DataFrame, places: DataFrame, how: str = "inner") -> DataFrame:
    """Joins (doc_id, at: array) to the texts, building on the small side."""
    return docs.join(
        places.withColumnRenamed("doc_id", "place_of").hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("place_of")), how
    ).drop("place_of")


def each_place(batches):
    """(doc_id, the text's words, the places) of every row of (doc_id, at, text)."""
    for (doc_id, at), texts in rows_of(batches):
        yield from zip(doc_id.to_pylist(), [(t or b"").split() for t in texts], at.to_pylist())


def digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def window_hashes(docs: DataFrame, places: DataFrame, k: int) -> DataFrame:
    """(w, doc_id, start): a hash of each window that begins in (start, n) of ``at``."""

    def run(batches):
        for (doc_id, at), texts in rows_of(batches):
            words = Words(texts)
            runs, size = Runs(words.hash, WORD_STEP), np.diff(words.first)
            who, starts = [], []
            for t, spans in enumerate(at.to_pylist()):
                for s in spans:
                    stop = min(s["start"] + s["n"], int(size[t]) - k + 1)
                    starts.append(np.arange(s["start"], max(stop, s["start"])))
                    who.append(np.full(len(starts[-1]), t))
            who, starts = np.concatenate(who), np.concatenate(starts)
            i = words.first[who] + starts
            w = runs.run(i, i + k).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(w), doc_id.take(pa.array(who)), pa.array(starts)], ["w", "doc_id", "start"])

    both = with_places(docs, places).select("doc_id", "at", "text")
    return both.mapInArrow(run, "w long, doc_id long, start long")


def at_places(spans: DataFrame, *columns: str) -> DataFrame:
    return spans.groupBy("doc_id").agg(F.collect_list(F.struct(*columns)).alias("at"))


@tidy
def repeated_spans(docs: DataFrame, k: int = K, q: int = ANCHOR) -> DataFrame:
    """(doc_id, start, n, src_id, src_start, digest): runs of ``n`` windows whose
    words also start earlier, at the source; compacted, with a digest of the words
    read there."""
    once = pieces(docs, k, q, True).groupBy("a").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("a")
    once = stored(once, "repeated-anchors")  # a plain table, so that a skewed join can be split
    found = stored(pieces(docs, k, q, False).join(once, "a"), "repeated-pieces")

    place = F.struct("doc_id", "start")
    edges = stored(found.groupBy("a", "v").agg(F.min(place).alias("src"), F.first("n").alias("n"), F.count(F.lit(1)).alias("c")), "edges")
    branching = edges.groupBy("a").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("a")
    heads = edges.join(branching, "a").select(F.col("src.doc_id").alias("doc_id"), F.col("src.start").alias("start"), "n")
    windows = stored(window_hashes(docs, at_places(heads, "start", "n"), k), "windows")
    earliest = windows.groupBy("w").agg(F.min(place).alias("src"), F.count(F.lit(1)).alias("c")).where("c > 1").select("w", "src")
    place_of_source = (F.col("src.doc_id").alias("src_id"), F.col("src.start").alias("src_start"))
    single = windows.join(earliest, "w").where(F.col("src") < place).select("doc_id", "start", F.lit(1).cast("long").alias("n"), *place_of_source)
    copies = found.join(edges.where("c > 1").select("a", "v", "src"), ["a", "v"]).where(F.col("src") < place).select(
        "doc_id", "start", "n", *place_of_source
    )

    # Compaction of spans that follow each other here and at their source.
    line = Window.partitionBy("doc_id", "src_id", F.col("src_start") - F.col("start")).orderBy("start")
    reach = F.max(F.col("start") + F.col("n")).over(line.rowsBetween(Window.unboundedPreceding, -1))
    runs = single.unionByName(copies).withColumn("shift", F.col("src_start") - F.col("start")).withColumn(
        "breaks", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1))
    ).withColumn("run", F.sum("breaks").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    spans = stored(
        runs.groupBy("doc_id", "src_id", "shift", "run").agg(
            F.min("start").alias("start"), (F.max(F.col("start") + F.col("n")) - F.min("start")).alias("n"), F.min("src_start").alias("src_start")
        ).drop("shift", "run"),
        "spans",
    )

    def read(batches):
        for doc_id, words, places in each_place(batches):
            rows = [(doc_id, p["src_start"], p["n"], digest(words[p["src_start"] : p["src_start"] + p["n"] + k - 1])) for p in places]
            kinds = [pa.int64()] * 3 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["src_id", "src_start", "n", "digest"])

    sources = spans.select(F.col("src_id").alias("doc_id"), "src_start", "n").distinct()
    said = with_places(docs, at_places(sources, "src_start", "n")).select("doc_id", "at", "text").mapInArrow(
        read, "src_id long, src_start long, n long, digest binary"
    )
    said = said.select(*[F.col(c).alias(f"r_{c}") for c in said.columns])
    same = F.col("src_id").eqNullSafe(F.col("r_src_id")) & (F.col("src_start") == F.col("r_src_start")) & (F.col("n") == F.col("r_n"))
    return spans.join(said, same).select("doc_id", "start", "n", "src_id", "src_start", F.col("r_digest").alias("digest"))


def cut(text: bytes, words: list[bytes], gone: np.ndarray) -> bytes:
    """The text without its words marked in ``gone`` and the white space after them."""
    if not gone.any():
        return text
    out, at, keep_from = [], 0, 0
    for word, drop in zip(words, gone.tolist()):
        start = text.index(word, at)
        if drop and keep_from is not None:
            out.append(text[keep_from:start])
            keep_from = None
        elif not drop and keep_from is None:
            keep_from = start
        at = start + len(word)
    if keep_from is not None:
        out.append(text[keep_from:])
    return b"".join(out)


def without_repeats(docs: DataFrame, k: int = K, q: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every whole text without the words that a window of ``k`` words covers whose
    words also start earlier (at a smaller id, or earlier in the same document).

    Returns, one row per input row, all other columns in ``row`` (a struct), and
    doc_id, n_words, n_removed, kept (words joined by one space) and text (what is
    left as it was written). Windows are judged on the input. A null text has no
    words and stays null. Null ids come before all others. Rows that share an id
    are versions of one document, and a span counts only where the words agree;
    so exact repeats of a row keep their words. Texts of fewer than ``k`` words
    lose nothing. A single document has to fit a task's memory several times.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spans = repeated_spans(source, k, q)

    def run(batches):
        for (rest, _, at), texts in rows_of(batches):
            columns = [[] for _ in range(4)]
            for text, spans in zip(texts, at.to_pylist()):
                words = (text or b"").split()
                gone = np.zeros(len(words), bool)
                for s in spans or []:
                    a, b = s["start"], s["start"] + s["n"] + k - 1
                    if b <= len(words) and digest(words[a:b]) == s["digest"]:
                        gone[a:b] = True
                row = (len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist()) if not g]),
                       None if text is None else cut(text, words, gone))
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            new = [pa.array(c, t) if t != pa.string() else pa.array(c, pa.binary()).cast(t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([rest, *new], ["row", "n_words", "n_removed", "kept", "left"])

    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("row"),
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
    )
    both = with_places(rows, at_places(spans, "start", "n", "digest"), "left").select("row", "doc_id", "at", "text")
    schema = T.StructType(
        [rows.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
         T.StructField("kept", T.StringType()), T.StructField("left", T.StringType())]
    )
    done = both.mapInArrow(run, schema)
    return done.select("row", F.col(f"row.{id_col}").alias("doc_id"), "n_words", "n_removed", "kept", F.col("left").alias("text"))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
