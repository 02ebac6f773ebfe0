"""Language by rank-order profiles of letter n-grams.

A profile is the list of a language's most frequent 1- to 3-grams. A document
gets the language whose ranks are nearest to its own: the out-of-place distance
sums, over the document's n-grams, how far the two ranks are apart, and the
profile length for those that the profile lacks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from weekgrid.llm.common import cached, rows_of, table

PROFILE = 300
CHUNK = 250_000  # bytes of text whose n-grams are held at once
EDGE = 1  # stands for the start or end of a word; letters have larger numbers


def is_letter():
    return cached("letters", lambda: np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))


class Grams:
    """All n-grams of some texts: ``key`` holds document * size**3 + gram, where a
    gram is three positions in ``alphabet`` (0: nothing, 1: word edge)."""

    def __init__(self, texts: list[bytes | None]):
        lowered = [(t or b"").decode().lower() for t in texts]
        points = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le"), np.uint32)
        sizes = np.array([len(t) + 1 for t in lowered])
        text_of = np.repeat(np.arange(len(texts), dtype=np.uint64), sizes)
        text_of = np.concatenate([text_of[:1], text_of])
        letter = is_letter()[points]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] = True
        points, letter, text_of = np.where(letter, points, EDGE)[keep], letter[keep], text_of[keep]
        used = np.zeros(0x110000, bool)
        used[points] = True
        used[[0, EDGE]] = True
        self.alphabet = np.flatnonzero(used)
        place = np.zeros(0x110000, np.uint64)
        place[self.alphabet] = np.arange(len(self.alphabet), dtype=np.uint64)
        self.size = np.uint64(len(self.alphabet))
        at = np.flatnonzero(letter)
        here, before, after = place[points[at]], place[points[at - 1]], place[points[at + 1]]
        self.cube = self.size**np.uint64(3)
        base = text_of[at] * self.cube
        one = base + here * self.size * self.size
        two = base + (before * self.size + here) * self.size
        last = after == place[EDGE]
        two_end = base[last] + (here[last] * self.size + after[last]) * self.size
        three = base + (before * self.size + here) * self.size + after
        three = three[after > 0]
        self.key = np.concatenate([one, two, two_end, three])

    def counted(self, group=None):
        """(document or its group, gram as one number, count), sorted."""
        key = self.key
        if group is not None:
            key = group[(key // self.cube).astype(np.int64)] * self.cube + key % self.cube
        if len(key) and int(key.max()) < 1 << 32:
            key = key.astype(np.uint32)
        key = np.sort(key)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(key)))
        key = key[first].astype(np.uint64)
        return (key // self.cube).astype(np.int64), key % self.cube, count

    def spelled(self, gram):
        """Grams as 63-bit numbers that mean the same in every batch."""
        a, b, c = (self.alphabet[x.astype(np.int64)].astype(np.int64) for x in (
            gram // (self.size * self.size), gram // self.size % self.size, gram % self.size))
        return a << 42 | b << 21 | c


def profiles(docs: DataFrame, length: int, lang_col: str, text_col: str) -> DataFrame:
    """lang, gram, rank (from 0) of the ``length`` most frequent n-grams of all given rows."""

    def run(batches):
        for (lang,), texts in rows_of(batches, CHUNK):
            names, group = np.unique(np.array(lang.to_pylist(), object), return_inverse=True)
            grams = Grams(texts)
            who, gram, n = grams.counted(group.astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[who], pa.string()), pa.array(grams.spelled(gram)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"]
            )

    counts = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(run, "lang string, gram long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # A limit on the row number itself is applied by every task before the shuffle, so
    # that the rows of a language do not all meet.
    numbered = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("place", F.row_number().over(order))
    return numbered.where(F.col("place") <= length).select("lang", "gram", (F.col("place") - 1).alias("rank"))


def predict(
    docs: DataFrame, learned: dict[str, list[int]], length: int, id_col: str, text_col: str, keep_text: bool = False
) -> DataFrame:
    """doc_id (any type, passed through), lang_pred, score, and the text if asked
    for; ``learned`` has each language's grams in rank order."""
    languages = sorted(learned)
    known = [np.sort(np.array(learned[x], np.int64)) for x in languages]
    ranks = [np.argsort(np.array(learned[x], np.int64)) for x in languages]

    def run(batches):
        for (doc_id,), texts in rows_of(batches, CHUNK):
            grams, n = Grams(texts), len(texts)
            doc, gram, count = grams.counted()
            order = np.lexsort((np.arange(len(doc)), -count, doc))
            rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
            top = rank < length
            doc, rank, gram = doc[top], rank[top], grams.spelled(gram[order][top])
            far = np.zeros((len(languages), n))
            for k, (codes, places) in enumerate(zip(known, ranks)):
                at = np.minimum(np.searchsorted(codes, gram), len(codes) - 1)
                away = np.where(codes[at] == gram, np.minimum(np.abs(places[at] - rank), length), length)
                far[k] = np.bincount(doc, away, n)
            size = np.bincount(doc, minlength=n)
            if languages:
                best = far.argmin(0)
                score = np.where(size > 0, 1 - far.min(0) / np.maximum(size * length, 1), 0.0)
                pred = [languages[b] if s else "und" for b, s in zip(best, size)]
            else:
                score, pred = np.zeros(n), ["und"] * n
            more = {"text": pa.array(texts, pa.binary()).cast(pa.string())} if keep_text else {}
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array(pred), pa.array(score), *more.values()], ["doc_id", "lang_pred", "score", *more]
            )

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    if keep_text:
        schema = schema.add("text", T.StringType())
    return source.mapInArrow(run, schema)


def fold(id_col: str = "doc_id"):
    """Whether a document is held out; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def learn(docs: DataFrame, length: int = PROFILE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, list[int]]:
    """Profiles from all rows with text and language that are not held out: at most
    ``length`` numbers per language, so they fit the driver."""
    rows = docs.where(~fold(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    found: dict[str, list] = {}
    for r in profiles(rows, length, lang_col, text_col).collect():
        found.setdefault(r["lang"], []).append((r["rank"], r["gram"]))
    return {lang: [g for _, g in sorted(grams)] for lang, grams in found.items()}


def identify(
    docs: DataFrame, learned: dict[str, list[int]] | None = None, length: int = PROFILE,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """Language of every whole text: doc_id, held_out, lang_pred, score.

    ``und`` with score 0 where the text is null or has no letter, or nothing was
    learned (an empty table). Equal n-gram counts rank by code point, equal
    distances go to the first language by name. The score is 1 less the distance
    as a share of the largest possible one. A row with a null id is neither held
    out nor learned from; repeated rows count as often as they occur.
    """
    learned = learn(docs, length, id_col, text_col, lang_col) if learned is None else learned
    found = predict(docs, learned, length, id_col, text_col)
    return found.select("doc_id", F.coalesce(fold("doc_id"), F.lit(False)).alias("held_out"), "lang_pred", "score")


def spoken(docs: DataFrame, length: int = PROFILE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows, unchanged, whose text has a language: those without a letter, and
    those that share no n-gram with any profile, go."""
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[F.col(c) for c in others]).alias("row"), F.col(text_col).alias("text"))
    found = predict(rows, learn(docs, length, id_col, text_col, lang_col), length, "row", "text", keep_text=True)
    spoken_ones = found.where((F.col("lang_pred") != "und") & (F.col("score") > 0))
    return spoken_ones.select(*[F.col("text").alias(c) if c == text_col else F.col(f"doc_id.{c}").alias(c) for c in docs.columns])


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
