"""Concatenate and cut: token sequences of a fixed length from global offsets.

First pass: every document is encoded once and stored with its offset within
its partition. Second pass: prefix sums over the partitions' token totals give
each partition its place in the one long concatenation, and each document is
cut where a sequence ends. A document that crosses a cut gives several pieces;
no row moves between tasks.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weekgrid.llm.common import cached, rows_of, slices_of, stored, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LENGTH, END = 2048, 1
# A word of these letters and marks is at most two pre-tokens, whose bytes the vocabulary
# changes by case only.
EASY = re.compile(r"([A-Za-z]+)([,.;:!?]?)")
PART = re.compile(r"[A-Za-z]*[,.;:!?]?")
WORDS, CHUNK = 200_000, 2_000_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


class WordEncoder:
    """Encodes texts word by word (runs without ASCII white space), as no token and no
    normalisation of this vocabulary crosses white space. The words of a chunk are
    made distinct in Arrow, so that Python and the tokenizer see each one once. Ids
    of up to ``size`` words that a chunk has more than once are kept for later ones."""

    def __init__(self, path: str, size: int = WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.core = tokenizers.Tokenizer.from_file(path)
        added = [t.content for t in self.core.get_added_tokens_decoder().values()]
        # An added token that may stand inside an easy word would be found there.
        self.easy = EASY.fullmatch if path == VOCABULARY and not any(PART.fullmatch(t) for t in added) else lambda text: None
        self.size = size
        self.known: dict[bytes, int] = {}  # number of a kept word
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)  # of kept words, end to end

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, and where each word's ids end. Easy words go to the model
        itself; the others are encoded as one text and dealt out by character offsets."""
        texts = [w.decode() for w in words]
        easy = [self.easy(t) for t in texts]
        rest = [i for i, m in enumerate(easy) if m is None]
        tokenize = self.core.model.tokenize
        marks = {m: [x.id for x in tokenize(m)] for m in {m[2] for m in easy if m and m[2]}}
        own = [m and [x.id for x in tokenize(m[1].lower())] + marks.get(m[2], []) for m in easy]
        if rest:
            ends = np.cumsum(np.fromiter((len(texts[i]) + 1 for i in rest), np.int64, len(rest)))
            found = self.core.encode(" ".join(texts[i] for i in rest), add_special_tokens=False)
            ids = found.ids
            starts = np.fromiter((a for a, _ in found.offsets), np.int64, len(ids))
            cuts = np.searchsorted(starts, ends).tolist()
            for i, first, last in zip(rest, [0, *cuts], cuts):
                own[i] = ids[first:last]
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        return np.fromiter(chain.from_iterable(own), np.uint32, int(sizes.sum())), np.cumsum(sizes)

    def keep(self, words: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        room = max(min(self.size - len(self.known), len(words)), 0)
        n = int(ends[room - 1]) if room else 0
        self.known.update(zip(words[:room], range(len(self.ends) - 1, len(self.ends) - 1 + room)))
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends[:room]])
        self.ids = np.concatenate([self.ids, ids[:n]])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of each one's."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, b"").cast(pa.large_string()))
        words, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        real = pc.binary_length(words).to_numpy() > 0  # white space at an end of a text leaves an empty word
        offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
        coded = words.filter(pa.array(real)).dictionary_encode()
        distinct, which = coded.dictionary.cast(pa.large_binary()).to_pylist(), coded.indices.to_numpy()
        slot = np.fromiter((self.known.get(w, -1) for w in distinct), np.int64, len(distinct))
        new = np.flatnonzero(slot < 0)
        # Ids of new words stand behind those of kept ones.
        parts, ends = [self.ids], [self.ends]
        often = np.bincount(which, minlength=len(distinct)) > 1
        new = np.concatenate([new[often[new]], new[~often[new]]])
        slot[new] = len(self.ends) - 1 + np.arange(len(new))
        repeated, learnt = int(often[new].sum()), []
        for i in range(0, len(new), 10_000):
            names = [distinct[j] for j in new[i : i + 10_000].tolist()]
            ids, own = self.learn(names)
            learnt.append((names, ids, own))
            parts.append(ids)
            ends.append(own + ends[-1][-1])
        pool, ends = np.concatenate(parts), np.concatenate(ends)
        starts, lengths = ends[:-1], np.diff(ends)
        size = lengths[slot][which]
        first = starts[slot][which]
        before = np.concatenate([[0], np.cumsum(size)])
        out = pool[np.repeat(first - before[:-1], size) + np.arange(before[-1])]
        for k, (names, ids, own) in enumerate(learnt):
            here = min(max(repeated - 10_000 * k, 0), len(names))
            if here:
                self.keep(names[:here], ids, own[:here])
        return out, np.diff(before[offsets])


def encoded(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Ids of every document, an end id behind each, with the number of ids of
    the same partition before it."""

    def run(batches):
        encoder = cached(("packing", path), lambda: WordEncoder(path))
        part, before = TaskContext.get().partitionId(), 0
        for (doc_id,), texts in slices_of(batches, CHUNK):
            ids, sizes = encoder.encode(texts)
            ids = np.insert(ids, np.cumsum(sizes), end_id).astype("<u4")
            sizes = sizes + 1
            ends = np.cumsum(sizes)
            packed = pa.Array.from_buffers(
                pa.large_binary(), len(sizes), [None, pa.py_buffer(np.concatenate([[0], 4 * ends]).astype(np.int64)), pa.py_buffer(ids)]
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sizes), part, np.int32)), pa.array(before + ends - sizes), doc_id, pa.array(sizes), packed.cast(pa.binary())],
                ["part", "before", "doc_id", "doc_tokens", "ids"],
            )
            before += int(ends[-1])
            del ids, packed
            pa.default_memory_pool().release_unused()  # workers live on after the task

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "part int, before long, doc_id long, doc_tokens long, ids binary")


def pack(
    docs: DataFrame, path: str = VOCABULARY, length: int = LENGTH, end_id: int = END,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of sequences of ``length`` ids; only the last sequence is shorter.

    A null text is empty and gives its end id alone. Repeated rows and null ids
    are documents of their own. An empty table gives no pieces. A very long text
    gives as many pieces as it needs. Documents follow each other in the order
    of the stored first pass, so a lost executor cannot change the cuts.
    """
    tokens = stored(encoded(docs, path, end_id, id_col, text_col), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    # One row per partition of the first pass: bounded by the number of input splits.
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("base"))

    def run(batches):
        for (at, doc_id, doc_tokens), texts in rows_of(batches):
            columns = [[] for _ in range(8)]
            for first, doc, n, ids in zip(at.to_pylist(), doc_id.to_pylist(), doc_tokens.to_pylist(), texts):
                cuts = [0, *range(length - first % length, n, length), n]
                for a, b in zip(cuts, cuts[1:]):
                    piece = ids[4 * a : 4 * b]
                    row = (doc, a, b - a, zlib.crc32(piece), n, (first + a) // length, (first + a) % length, piece)
                    for column, value in zip(columns, row):
                        column.append(value)
            kinds = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], NAMES)

    placed = tokens.join(F.broadcast(bases), "part").select((F.col("base") + F.col("before")).alias("at"), "doc_id", "doc_tokens", "ids")
    return placed.mapInArrow(run, PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole sequences: one row per ``sequence_id`` with its ids; a sequence has
    at most ``length`` ids, which bounds every group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("ids")
