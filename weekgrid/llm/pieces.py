"""Token counts from pre-token frequencies, without making token ids.

The sentencepiece model merges within a pre-token only: no piece has a space
mark after another character, so a text is cut before every run of spaces and
the counts of the parts add up. Every distinct pre-token is counted once.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weekgrid.llm.common import cached, rows_of, stored, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
HEAD, SAMPLE = 200_000, 32
SPACE = "▁"  # the model's mark for a space; as text it means the same


def model_of(path: str):
    return cached(("pieces", path), lambda: sentencepiece.SentencePieceProcessor(model_file=path))


def pre_tokens(text: str) -> list[str]:
    """Parts that begin with their spaces; the first space is the model's own."""
    if not text:
        return []
    parts = (" " + text.replace(SPACE, " ")).split(" ")
    if "" not in parts[1:]:
        return parts[1:]
    out, spaces = [], 0
    for i, part in enumerate(parts[1:]):
        if part == "" and i < len(parts) - 2:
            spaces += 1
        else:
            out.append(" " * spaces + part)
            spaces = 0
    return out


def check_model(path: str) -> None:
    """Raises unless counts of pre-tokens add up under this model."""
    model = model_of(path)
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if SPACE in piece.lstrip(SPACE):
            raise ValueError(f"piece {i} crosses a pre-token's end")
    if model.encode(" a") != model.encode("  a")[1:] and len(model.encode(" ")) != 1:
        raise ValueError("the model drops spaces")


def count_pieces(path: str):
    @F.pandas_udf(T.LongType())
    def count(words):
        # The library gives nothing for an empty text; as a pre-token it is one space mark.
        found = model_of(path).encode(words.tolist(), num_threads=1)
        return pd.Series([len(ids) if word else 1 for word, ids in zip(words, found)], dtype="int64")

    return count


def split_documents(docs: DataFrame, head: dict[str, int], id_col: str, text_col: str) -> DataFrame:
    """Per row: bytes, tokens of its pre-tokens in ``head``, and the other ones with their frequencies."""
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def run(batches):
        known = shared.value
        for (doc_id,), texts in rows_of(batches):
            sizes, sums, tails = [], [], []
            for text in texts:
                sizes.append(len(text or b""))
                total, tail = 0, []
                for word, n in Counter(pre_tokens((text or b"").decode())).items():
                    got = known.get(word)
                    if got is None:
                        tail.append((word, n))
                    else:
                        total += got * n
                sums.append(total)
                tails.append(tail)
            offsets = [0]
            for tail in tails:
                offsets.append(offsets[-1] + len(tail))
            pairs = pa.StructArray.from_arrays(
                [pa.array([w for t in tails for w, _ in t], pa.string()), pa.array([n for t in tails for _, n in t], pa.int64())],
                ["word", "n"],
            )
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)],
                ["doc_id", "n_bytes", "head_tokens", "tail"],
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, n_bytes long, head_tokens long, tail array<struct<word:string,n:long>>"
    return source.mapInArrow(run, schema)


def frequent(docs: DataFrame, path: str, size: int, sample: int, id_col: str, text_col: str) -> dict[str, int]:
    """Piece counts of the ``size`` most frequent pre-tokens of one document in
    ``sample`` (chosen by a hash of its text). It only decides which pre-tokens
    are shuffled, never a result."""
    some = docs.where(F.pmod(F.xxhash64(text_col), F.lit(sample)) == 0)
    words = split_documents(some, {}, id_col, text_col).select(F.explode("tail").alias("t"))
    top = words.groupBy(F.col("t.word").alias("word")).agg(F.sum("t.n").alias("n")).orderBy(F.desc("n"), "word").limit(size)
    return {r["word"]: r["pieces"] for r in top.select("word", count_pieces(path)("word").alias("pieces")).collect()}


def token_counts(
    docs: DataFrame, path: str = MODEL, limit: int = 4096, head_size: int = HEAD, sample: int = SAMPLE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Number of tokens of every whole text, one row per input row.

    A null text is empty and has no tokens. Repeated rows and null ids stay rows
    of their own: rows are told apart by a number of the stored table. The
    ``head_size`` most frequent pre-tokens (a bounded table, broadcast) are added
    up where the text is read, so no frequent one becomes a hot key; all others
    are counted once each and joined to the per-document frequencies.
    """
    check_model(path)
    head = frequent(docs, path, head_size, sample, id_col, text_col)
    split = stored(
        split_documents(docs, head, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "pre-tokens"
    )
    pairs = split.select("row", F.explode("tail").alias("t")).select("row", "t.word", F.col("t.n").alias("freq"))
    counts = stored(pairs.groupBy("word").agg(F.lit(1).alias("one")).select("word", count_pieces(path)("word").alias("pieces")), "pieces")
    tails = pairs.join(counts, "word").groupBy("row").agg(F.sum(F.col("freq") * F.col("pieces")).alias("tail_tokens"))
    n = F.col("head_tokens") + F.coalesce("tail_tokens", F.lit(0))
    rows = split.select("row", "doc_id", "n_bytes", "head_tokens").join(tails, "row", "left")
    return rows.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
