"""Byte-level BPE by tree reduction, and its decoding.

The encodings of two neighbouring spans are joined by encoding again only what
lies at the seam. Two facts bound that window:

* The pattern never looks back, and ahead of a match's start by three characters
  or of its end by one. So in the left span only the last matches can change,
  and as soon as a match ends where one of the right span ends, the rest of the
  right span is final.
* Inside one long match, a token sequence is the encoding of its bytes if and
  only if every two neighbours, encoded together, stay the same two tokens. The
  window grows until that holds at both of its ends.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from weekgrid.llm.common import cached, rows_of, table

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LEAF = 2048
LONG = 256
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary, decoded binary"


class Node:
    """Encoding of text[a:b]: its ids, and the ends of its first and last match."""

    __slots__ = ("a", "b", "ids", "first_end", "first_ids", "last_start", "last_ids")

    def __init__(self, a, b, ids, first_end, first_ids, last_start, last_ids):
        self.a, self.b, self.ids = a, b, ids
        self.first_end, self.first_ids, self.last_start, self.last_ids = first_end, first_ids, last_start, last_ids


class TreeEncoder:
    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN, leaf: int = LEAF, long: int = LONG):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.core = tiktoken.Encoding("tree", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.leaf, self.long = leaf, long

    def piece(self, text: str) -> list[int]:
        """One match of the pattern; a long one by halves."""
        if len(text) <= self.leaf:
            return self.core.encode_ordinary(text)
        half = len(text) // 2
        return self.seam(self.piece(text[:half]), self.piece(text[half:]))

    def stable(self, left: int, right: int) -> bool:
        return self.core._encode_single_piece(self.bytes_of[left] + self.bytes_of[right]) == [left, right]

    def seam(self, left: list[int], right: list[int]) -> list[int]:
        """The tokens of two neighbouring parts of one match."""
        if not left or not right:
            return left + right
        k = 1
        while True:
            i, j = max(0, len(left) - k), min(len(right), k)
            window = b"".join(map(self.bytes_of.__getitem__, left[i:] + right[:j]))
            middle = self.core._encode_single_piece(window)
            if (i == 0 or self.stable(left[i - 1], middle[0])) and (
                j == len(right) or self.stable(middle[-1], right[j])
            ):
                return left[:i] + middle + right[j:]
            k *= 2

    def tail(self, matches, b: int) -> tuple[int, int]:
        """Start and number of ids of the matches that text after b could change:
        those that touch b, and those too near to it for a contraction."""
        k = next(k for k, (start, end, _) in enumerate(matches) if end == b or start + 3 > b)
        return matches[k][0], sum(n for _, _, n in matches[k:])

    def leaf_node(self, text: str, a: int, b: int) -> Node:
        first = self.pattern.match(text, a, b).end()
        seam = text.rfind(" ", a + 1, max(a + 1, b - 8))
        near_end = seam if seam > 0 and not text[seam - 1].isspace() else a  # no match holds a space after other characters
        spans = [m.span() for m in self.pattern.finditer(text, near_end, b)]
        near = [(s, e, len(self.piece(text[s:e]))) for s, e in spans[-3:]]
        return Node(a, b, self.core.encode_ordinary(text[a:b]), first, len(self.piece(text[a:first])), *self.tail(near, b))

    def join(self, text: str, x: Node, y: Node) -> Node:
        at, middle, spans = x.last_start, [], []
        cut, other, after = 0, y.a, None  # ids of y that go, and the place up to which they reach
        while True:
            end = self.pattern.match(text, at, y.b).end()
            if at < y.a and end == y.first_end and end - at > self.long and self.pattern.match(text, at, y.a).end() == y.a:
                ids = self.seam(x.ids[len(x.ids) - x.last_ids + sum(n for _, _, n in spans) :], y.ids[: y.first_ids])
            else:
                ids = self.piece(text[at:end])
            spans.append((at, end, len(ids)))
            middle += ids
            at = end
            while other < at:
                if after is None:
                    other, n = y.first_end, y.first_ids
                    after = self.pattern.finditer(text, other, y.b)
                else:
                    m = next(after)
                    other, n = m.end(), len(self.piece(m.group()))
                cut += n
            if other == at:
                break
        ids = x.ids[: len(x.ids) - x.last_ids] + middle + y.ids[cut:]
        first = (x.first_end, x.first_ids) if x.last_start > x.a else spans[0][1:]
        if y.last_start >= at and at < y.b:
            return Node(x.a, y.b, ids, *first, y.last_start, y.last_ids)
        rest = [(*m.span(), len(self.piece(m.group()))) for m in self.pattern.finditer(text, at, y.b)]
        return Node(x.a, y.b, ids, *first, *self.tail(spans + rest, y.b))

    def node(self, text: str, a: int, b: int) -> Node:
        if b - a <= self.leaf:
            return self.leaf_node(text, a, b)
        half = (a + b) // 2
        return self.join(text, self.node(text, a, half), self.node(text, half, b))

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf:
            return self.core.encode_ordinary(text)
        return self.node(text, 0, len(text)).ids

    def decode(self, ids: list[int]) -> bytes:
        """Concatenates halves up the tree."""
        if len(ids) <= self.leaf:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def encode_documents(
    docs: DataFrame, path: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF, keep: bool = True
) -> DataFrame:
    """Ids of every whole text and the bytes they decode to, one row per input row.

    ``ids`` are little-endian unsigned 32-bit integers, ``decoded`` UTF-8 bytes;
    both only if ``keep``. A null text counts as empty: no tokens. Repeated rows
    and null ids pass as they are; other columns are not read.
    """

    def run(batches):
        encoder = cached(("bpe_tree", path, leaf), lambda: TreeEncoder(path, leaf=leaf))
        for (doc_id,), texts in rows_of(batches):
            n, ids_hash, back_hash, all_ids, all_back = [], [], [], [], []
            for text in texts:
                ids = encoder.encode((text or b"").decode())
                packed = np.array(ids, "<u4").tobytes()
                back = encoder.decode(ids)
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(packed).hexdigest())
                back_hash.append(hashlib.sha256(back).hexdigest())
                all_ids.append(packed if keep else None)
                all_back.append(back if keep else None)
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array(n, pa.int64()), pa.array(ids_hash), pa.array(back_hash),
                 pa.array(all_ids, pa.binary()), pa.array(all_back, pa.binary())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"],
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, SCHEMA)


def op10_byte_bpe(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return encode_documents(docs, keep=False).drop("ids", "decoded")
